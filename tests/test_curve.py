"""Files along a space-filling curve: nothing lost, every column prunes."""

import datetime
import random
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stammwerk.session import fresh_path
from stammwerk.sinks.curve import (
    bits_for,
    curve_place,
    files_for,
    manifest,
    range_number,
    read_curve,
    sort_keys,
    write_curve,
)


@pytest.fixture
def path(spark):
    return fresh_path(spark, "curve")


def three_columns(spark, n=4000):
    rng = random.Random(4)
    day = datetime.date(2024, 1, 1)
    data = [(i, rng.randrange(1000), day + datetime.timedelta(rng.randrange(700)), f"name-{rng.randrange(500):04d}")
            for i in range(n)]
    return spark.createDataFrame(data, "id long, a int, d date, s string").repartition(3, "id")


def test_places_interleave_bits(spark):
    numbers = [(x, y) for x in range(8) for y in range(8)]
    df = spark.createDataFrame(numbers, "x int, y int")
    found = df.select("x", "y", curve_place([F.col("x"), F.col("y")], 3).alias("p")).collect()
    for r in found:
        want = 0
        for b in (2, 1, 0):
            want = want << 2 | (r.x >> b & 1) << 1 | (r.y >> b & 1)
        assert r.p == want


def test_range_numbers_against_counting(spark):
    bounds = [1.0, 1.0, 2.5, 7.0, 7.0, 7.0, 9.0]
    df = spark.createDataFrame([(x / 2,) for x in range(-2, 22)] + [(None,)], "x double")
    for r in df.select("x", range_number(F.col("x"), bounds).alias("n")).collect():
        assert r.n == (0 if r.x is None else sum(b <= r.x for b in bounds))


def test_string_keys_rise_with_the_strings(spark):
    words = ["pre", "prea", "preaa", "preb", "préz", "preé", "pre\x7f", "prez" * 9]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    key = sort_keys(df, ["s"])["s"]
    found = [r.k for r in df.orderBy("s").select(key.alias("k")).collect()]
    assert found == sorted(found) and len(set(found)) >= 6


def test_every_column_prunes_and_rows_stay(spark, path):
    df = three_columns(spark)
    write_curve(df, path, ["a", "d", "s"], files=64)
    assert rows(read_curve(spark, path)) == rows(df)
    n_files = manifest(spark, path).count()
    assert n_files >= 50
    for column, low, high in (
        ("a", 100, 150),
        ("d", datetime.date(2024, 3, 1), datetime.date(2024, 4, 1)),
        ("s", "name-0100", "name-0120"),
    ):
        opened = files_for(spark, path, {column: (low, high)})
        assert len(opened) <= n_files * 0.5, column
        want = df.where(F.col(column).between(low, high))
        assert rows(read_curve(spark, path, {column: (low, high)})) == rows(want)
    both = {"a": (0, 300), "d": (None, datetime.date(2024, 6, 1))}
    assert len(files_for(spark, path, both)) < len(files_for(spark, path, {"a": (0, 300)}))
    want = df.where("a <= 300 AND d <= DATE'2024-06-01'")
    assert rows(read_curve(spark, path, both)) == rows(want)


def test_sorted_files_prune_by_their_first_column_only(spark, path):
    """What the curve is for: the same files sorted by (a, d, s) do not prune by d or s."""
    df = three_columns(spark)
    write_curve(df, path, ["a", "d", "s"], files=64)
    day = datetime.date(2024, 3, 1)
    by_curve = len(files_for(spark, path, {"d": (day, day)}))
    plain = (
        df.repartitionByRange(64, "a", "d", "s").groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("d").alias("least"), F.max("d").alias("most"))
        .where(F.lit(day).between(F.col("least"), F.col("most"))).count()
    )
    assert by_curve * 2 < plain


def test_a_frequent_value_is_many_files(spark, path):
    df = spark.range(3000).select("id", F.lit(7).alias("a"), F.lit("x").alias("s"))
    write_curve(df, path, ["a", "s"], files=10)
    sizes = [r.n_rows for r in manifest(spark, path).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    assert read_curve(spark, path, {"a": (7, 7)}).count() == 3000
    assert files_for(spark, path, {"a": (8, None)}) == []
    assert read_curve(spark, path, {"a": (8, None)}).count() == 0


def test_nulls_ties_clashing_names_and_maps(spark, path):
    data = [(None, None, 1.5, {"k": 1}), (None, "x", float("nan"), None), (3, None, None, {}),
            (3, "x", 1.5, {"k": 1}), (3, "x", 1.5, {"k": 1})]
    schema = "a int, curve_place string, load double, curve_salt map<string,int>"
    df = spark.createDataFrame(data, schema)
    write_curve(df, path, ["a", "curve_place", "load"], files=3)
    found = read_curve(spark, path)
    assert found.columns == df.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, df.collect()))
    assert read_curve(spark, path, {"a": (None, 3)}).count() == 3
    assert read_curve(spark, path, {"load": (0.0, 2.0)}).count() == 3


def test_loads_add_up_and_an_unfinished_one_is_not_seen(spark, path):
    df = three_columns(spark, 300)
    write_curve(df.where("id < 100"), path, ["a", "d"], files=4)
    write_curve(df.where("id >= 100"), path, ["a", "d"], files=4)
    df.write.parquet(f"{path}/rows/{uuid.uuid4().hex}")  # died before its manifest
    assert rows(read_curve(spark, path)) == rows(df)


def test_empty_frame_and_wrong_columns(spark, path):
    df = three_columns(spark, 10)
    write_curve(df.limit(0), path, ["a", "s"], files=4)
    assert read_curve(spark, path).columns == df.columns and read_curve(spark, path).count() == 0
    assert read_curve(spark, path, {"a": (1, 2)}).count() == 0
    with pytest.raises(ValueError, match="no cluster columns"):
        write_curve(df, path, [])
    with pytest.raises(TypeError, match="cannot cluster"):
        write_curve(df.withColumn("m", F.array(F.lit(1))), path, ["m"])


def test_bits_follow_the_files():
    assert bits_for(64, 3) == 4
    assert bits_for(1, 1) == 3
    assert bits_for(10**6, 1) == 10
    assert bits_for(10**9, 31) == 2
