import random

import pytest
from pyspark.sql import functions as F

from stammwerk.operators.profile import (
    Limits, content_findings, earlier_profiles, estimates, merge_profiles, profile, store_profile,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, name string, amount double, day date, tags array<string>")


def load(seed, n=4000, nulls=0.1, shift=0, value=None):
    import datetime

    rng = random.Random(seed)
    return [(i + seed * n, value or rng.choice("abcdefgh") * rng.randint(1, 40),
             None if rng.random() < nulls else rng.gauss(shift, 1),
             datetime.date(2024, 1, 1) + datetime.timedelta(rng.randint(0, 300)), ["x"]) for i in range(n)]


def by_column(df):
    return {r.column: r for r in df.collect()}


def test_exact_parts_and_errors_of_sketches(spark):
    rows = load(1)
    rows += rows[:7]
    found = by_column(estimates(profile(frame(spark, rows), ["k"])))
    assert {r.rows for r in found.values()} == {4007} and {r.repeats for r in found.values()} == {7}
    for i, c in enumerate(("k", "name", "amount", "day")):
        assert found[c].nulls == sum(r[i] is None for r in rows)
        exact = len({r[i] for r in rows} - {None})
        assert abs(found[c].distinct - exact) <= 0.07 * exact + 1
    values = sorted(r[2] for r in rows if r[2] is not None)
    for q, v in zip((0.25, 0.5, 0.75), found["amount"].quartiles):
        assert abs(sum(x <= v for x in values) / len(values) - q) < 0.03
    assert found["name"].quartiles is None and len(found["name"].frequent) == 5


def test_merged_profiles_equal_one_of_all(spark):
    loads = [load(s) for s in range(3)]
    parts = [profile(frame(spark, rows)) for rows in loads]
    merged = by_column(estimates(merge_profiles(parts[0].union(parts[1]).union(parts[2]))))
    whole = by_column(estimates(profile(frame(spark, sum(loads, [])))))
    for c, r in whole.items():
        assert (merged[c].rows, merged[c].nulls) == (r.rows, r.nulls)
        assert merged[c].distinct == pytest.approx(r.distinct, rel=0.08)


def failed(findings):
    return sorted(f"{f.check}:{f.field}" for f in findings if not f.ok)


def test_loads_are_held_against_earlier_ones(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS profiles")
    table = "profiles.things"
    try:
        assert earlier_profiles(spark, table, "2024-01-01") is None
        for day in range(1, 4):
            for _ in range(2):  # storing a date again replaces it
                store_profile(profile(frame(spark, load(day)), ["k"]), table, f"2024-01-0{day}")
        earlier = earlier_profiles(spark, table, "2024-01-04")
        assert earlier.count() == 15

        def judge(rows, limits=Limits(growing=("k",))):
            return failed(content_findings(profile(frame(spark, rows), ["k"]), earlier, limits))

        assert judge(load(9)) == []
        assert judge(load(9), Limits()) == ["median:k"]
        again = load(9)
        assert judge(again + again[:1]) == ["key_repeats:"]
        assert judge(again + again[:1], Limits(repeats=1, growing=("k",))) == []
        assert judge(load(9, n=500)) == ["row_count:"]
        assert judge(load(9, nulls=0.4)) == ["null_share:amount"]
        assert judge(load(9, shift=5)) == ["median:amount"]
        assert judge(load(9, value="new")) == ["new_value:name"]
        assert failed(content_findings(profile(frame(spark, again + again[:1]), ["k"]), None)) == ["key_repeats:"]
    finally:
        spark.sql("DROP SCHEMA profiles CASCADE")


def test_empty_loads(spark):
    found = by_column(estimates(profile(frame(spark, []), ["k"])))
    assert {(r.rows, r.nulls, r.repeats) for r in found.values()} == {(0, 0, 0)}
    assert all(r.quartiles is None for r in found.values())
    earlier = profile(frame(spark, load(1))).withColumn("md_book_date", F.lit("2024-01-01").cast("date"))
    assert failed(content_findings(profile(frame(spark, [])), earlier)) == ["row_count:"]
