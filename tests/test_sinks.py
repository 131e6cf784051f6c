from pathlib import Path

import pytest
from conftest import rows

from stammwerk.sinks.writers import create_target, resolve_target, write_path, write_table


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "a int, p string, v double")


def test_target_names(spark):
    catalog = spark.catalog.currentCatalog()
    assert resolve_target(spark, "default.t") == f"{catalog}.default.t"
    assert resolve_target(spark, f"{catalog}.default.t") == f"{catalog}.default.t"
    for bad in ("t", "a.b.c.d", "default.", "nosuchschema.t"):
        with pytest.raises(ValueError):
            resolve_target(spark, bad)


def test_load_types(spark, df):
    write_table(df, "default.loads", "initial")
    write_table(df, "default.loads", "delta")
    assert spark.table("loads").count() == 4
    write_table(df.where("a = 1"), "default.loads", "initial")
    assert rows(spark.table("loads")) == [(1, "x", 1.0)]
    with pytest.raises(ValueError):
        write_table(df, "default.loads", "append")


def test_initial_load_replaces_all_partitions(spark, df):
    write_table(df, "default.parts", "initial", ["p"])
    write_table(df.where("p = 'y'"), "default.parts", "initial", ["p"])
    assert rows(spark.table("parts"), "a", "p") == [(2, "y")]


def test_columns_go_in_by_name_and_missing_ones_are_null(spark, df):
    write_table(df, "default.named", "initial")
    write_table(df.select("p", "a"), "default.named", "delta")
    assert rows(spark.table("named").where("v IS NULL"), "a", "p") == [(1, "x"), (2, "y")]


def test_columns_that_would_be_lost_raise(spark, df):
    write_table(df, "default.strict", "initial")
    with pytest.raises(ValueError, match="does not have"):
        write_table(df.selectExpr("*", "1 AS more"), "default.strict", "delta")
    with pytest.raises(ValueError, match="case only"):
        write_table(df.withColumnRenamed("v", "V"), "default.strict", "delta")
    assert spark.table("strict").count() == 2


def test_initial_load_replaces_all_partitions_in_dynamic_mode(spark, df, tmp_path):
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "dynamic")
    try:
        write_table(df, "default.dynamic", "initial", ["p"])
        write_table(df.where("p = 'y'"), "default.dynamic", "initial")
        path = str(tmp_path / "out")
        write_path(df, path, "initial", ["p"])
        write_path(df.where("p = 'y'"), path, "initial", ["p"])
        assert spark.conf.get(mode) == "dynamic"
    finally:
        spark.conf.unset(mode)
    assert rows(spark.table("dynamic"), "a", "p") == [(2, "y")]
    assert rows(spark.read.parquet(path), "a", "p") == [(2, "y")]


def test_a_replaced_partition_takes_no_other_rows(spark, df):
    write_table(df, "default.dated", "initial", ["p"])
    with pytest.raises(Exception, match="p should be y, not x"):
        write_table(df, "default.dated", "delta", replace_partition={"p": "y"})
    assert spark.table("dated").count() == 2


def test_an_append_takes_the_tables_bucket_count(spark, tmp_path):
    df = spark.range(1000).repartition(16)
    path = tmp_path / "t"
    write_table(df, "default.counted", "initial", cluster_columns=["id"], buckets=3, path=str(path))
    before = set(path.glob("*.parquet"))
    write_table(df, "default.counted", "delta")
    assert 0 < len(set(path.glob("*.parquet")) - before) <= 3


def test_one_partition_is_replaced(spark, df):
    write_table(df, "default.replaced", "initial", ["p"])
    write_table(df.where("p = 'y'").selectExpr("a", "p", "v + 1 AS v"), "default.replaced", "delta",
                replace_partition={"p": "y"})
    assert rows(spark.table("replaced"), "a", "p", "v") == [(1, "x", 1.0), (2, "y", 3.0)]
    write_table(df.where("false"), "default.replaced", "delta", replace_partition={"p": "y"})
    assert rows(spark.table("replaced"), "a") == [(1,)]


def test_bucketed_append_keeps_the_layout(spark, df):
    for load_type in ("initial", "delta"):
        write_table(df, "default.bucketed", load_type, ["p"], ["a", "p"], buckets=4)
    columns = {c.name: (c.isPartition, c.isBucket) for c in spark.catalog.listColumns("bucketed")}
    assert columns == {"a": (False, True), "v": (False, False), "p": (True, False)}
    assert rows(spark.table("bucketed"), "a") == [(1,), (1,), (2,), (2,)]


def test_one_file_per_bucket(spark, tmp_path):
    df = spark.range(1000).repartition(16)
    write_table(df, "default.filed", "initial", cluster_columns=["id"], buckets=4, path=str(tmp_path / "t"))
    assert len(list((tmp_path / "t").glob("*.parquet"))) <= 4


def test_created_target_is_empty(spark, df):
    create_target(spark, "default.created", df.schema, ["p"], ["a"], buckets=2)
    assert spark.table("created").count() == 0
    assert spark.table("created").columns == ["a", "v", "p"]


def test_paths(spark, df, tmp_path):
    path = str(tmp_path / "out")
    write_path(df, path, "initial", ["p"], ["a", "p"])
    write_path(df, path, "delta", ["p"])
    assert rows(spark.read.parquet(path), "a", "p") == [(1, "x"), (1, "x"), (2, "y"), (2, "y")]
    assert {f.name for f in Path(path).iterdir() if f.is_dir()} == {"p=x", "p=y"}
    write_path(df.where("a = 2"), path, "initial", ["p"], replace_partitions=True)
    assert rows(spark.read.parquet(path), "a", "p") == [(1, "x"), (1, "x"), (2, "y")]
    write_path(df.where("a = 2"), path, "initial", ["p"])
    assert rows(spark.read.parquet(path), "a", "p") == [(2, "y")]


def test_files_are_sorted_by_cluster_columns(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(500).selectExpr("(id * 7919) % 500 AS k", "id AS v").repartition(8)
    write_path(df, path, "initial", cluster_columns=["k"])
    for file in Path(path).glob("*.parquet"):
        keys = [r.k for r in spark.read.parquet(str(file)).collect()]
        assert keys == sorted(keys)


def test_other_formats(spark, df, tmp_path):
    write_path(df, str(tmp_path / "orc"), "initial", file_format="orc")
    assert spark.read.orc(str(tmp_path / "orc")).count() == 2
