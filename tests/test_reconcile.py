import random
from collections import Counter

import pytest
from conftest import jobs_of, plan_of
from pyspark.sql import functions as F

from stammwerk.operators.reconcile import Ranges, compare_tables, key_ranges

SCHEMA = "k long, a string, b double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def base(n=2000):
    rng = random.Random(n)
    return [(rng.choice([None, *range(n)]), rng.choice(["x", "y", None]), rng.choice([1.5, 2.5, None])) for _ in range(n)]


def slow(left, right):
    counts = Counter(left)
    counts.subtract(Counter(right))
    return sorted(((*row, "left" if n > 0 else "right", abs(n)) for row, n in counts.items() if n), key=str)


@pytest.mark.parametrize("planted", ["lost", "doubled", "changed", "null key", "swapped", "all"])
def test_planted_differences(spark, planted):
    left = base()
    right = list(left)
    if planted in ("lost", "all"):
        del right[17], right[900]
    if planted in ("doubled", "all"):
        right += [right[3], right[3], right[700]]
    if planted in ("changed", "all"):
        right[40] = (right[40][0], "z", right[40][2])
    if planted in ("null key", "all"):
        right.append((None, "only here", None))
    if planted in ("swapped", "all"):  # the same cells in other rows
        i, j = [n for n, r in enumerate(right) if r[1] == "x" and r[0]][:1] + [n for n, r in enumerate(right) if r[1] == "y" and r[0]][:1]
        right[i], right[j] = (right[i][0], "y", right[i][2]), (right[j][0], "x", right[j][2])
    random.Random(1).shuffle(right)
    found = compare_tables(frame(spark, left), frame(spark, right).select("b", "k", "a"), "k")
    assert not found.equal
    assert sorted(map(tuple, found.differences.collect()), key=str) == slow(left, right)
    assert 0 < len(found.differing) < 30 and found.levels[0] == 1


def test_equal_tables_are_read_once(spark):
    rows = base()
    left, right = frame(spark, rows), frame(spark, rows[::-1]).repartition(5)
    found = compare_tables(left, right, "k")
    assert found.equal and found.levels == (0, 0, 0)
    with jobs_of(spark) as jobs:
        assert found.differences.count() == 0
        assert len(jobs()) <= 2


def test_ranges_reach_the_scan(spark, tmp_path):
    frame(spark, [(i, "x", 1.0) for i in range(5000)]).write.parquet(str(tmp_path / "l"))
    left = spark.read.parquet(str(tmp_path / "l"))
    right = left.withColumn("a", F.when(F.col("k") == 4321, "y").otherwise(F.col("a")))
    found = compare_tables(left, right, "k")
    assert len(found.differing) == 1 and found.levels == (1, 1, 1)
    plan = plan_of(found.differences)
    assert "GreaterThanOrEqual(k," in plan and "LessThan(k," in plan


def test_range_numbers(spark):
    ranges = Ranges("k", (10, 20, 30))
    rows = spark.createDataFrame([(v,) for v in (None, 5, 10, 19, 20, 30, 99)], "k int")
    assert [r[0] for r in rows.select(ranges.number()).collect()] == [-1, 0, 1, 1, 2, 3, 3]
    for wanted in ([-1], [0], [3], [0, 1], [1, 2], [-1, 0, 3], []):
        kept = rows.where(ranges.rows_of(wanted)).select(ranges.number()).collect()
        assert sorted({r[0] for r in kept}) == wanted


def test_empty_tables_and_wrong_inputs(spark):
    none, some = frame(spark, []), frame(spark, base(10))
    assert compare_tables(none, none, "k").equal
    assert compare_tables(none, some, "k").differences.agg(F.sum("times")).first()[0] == 10
    assert compare_tables(some, none, "k").differences.where("side = 'left'").agg(F.sum("times")).first()[0] == 10
    with pytest.raises(ValueError, match="columns differ"):
        compare_tables(some, some.drop("a"), "k")
    with pytest.raises(ValueError, match="types"):
        compare_tables(some, some.withColumn("a", F.lit(1)), "k")
    with pytest.raises(ValueError, match="ranges need"):
        key_ranges(some, "a")
