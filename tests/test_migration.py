"""Findings of the gate as a plan, and the plan carried out."""

import math
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stammwerk.operators.gate import STRICT, WIDE, Target, check_frame, describe_target, passes
from stammwerk.plans import migration
from stammwerk.plans.feeds import DELTA, INITIAL
from stammwerk.plans.jobs import gated_load
from stammwerk.plans.migration import converted, holds_all, migrate, partition_locations, plan_migration
from stammwerk.session import fresh_path
from stammwerk.sinks.writers import create_target, write_table

SCHEMA = "id int, x float, s string, d string"
DATA = [(1, 1.5, "a", "p q"), (2, None, "b", "r/s='t'"), (None, 2.5, None, None), (1, 1.5, "a", "p q")]


@pytest.fixture
def table(spark):
    return f"default.migrated_{uuid.uuid4().hex}"


def made(spark, table, external=True, partition=("d",), cluster=(), schema=SCHEMA, data=DATA):
    df = spark.createDataFrame(data, schema)
    path = fresh_path(spark, "migrated") if external else None
    create_target(spark, table, df.schema, partition, cluster, 3, path)
    write_table(df, table, INITIAL)
    return df


def as_text(df):
    return sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def files_below(spark, table):
    return {r[0] for r in spark.table(table).select(F.input_file_name()).distinct().collect()}


def test_add_touches_no_file(spark, table):
    df = made(spark, table)
    before = files_below(spark, table)
    wider = df.withColumn("note", F.lit("n"))
    plan = migrate(spark, table, wider.schema)
    assert [str(s) for s in plan.steps] == ["add note string"]
    assert files_below(spark, table) == before
    assert as_text(spark.table(table)) == as_text(df.withColumn("note", F.lit(None).cast("string")))
    assert gated_load(wider, table, DELTA).written
    assert spark.table(table).where("note = 'n'").count() == 4


def test_widen_keeps_the_files_of_partitions(spark, table):
    df = made(spark, table)
    before = files_below(spark, table)
    wide = df.withColumns({"id": F.col("id").cast("long") + 2**40, "x": F.col("x").cast("double")})
    plan = migrate(spark, table, wide.schema, mode=WIDE)
    assert [str(s) for s in plan.steps] == ["widen id bigint", "widen x double"]
    assert files_below(spark, table) == before
    want = df.withColumns({"id": F.col("id").cast("long"), "x": F.col("x").cast("double")})
    assert as_text(spark.table(table)) == as_text(want)
    assert gated_load(wide, table, DELTA, type_mode=WIDE).written
    assert as_text(spark.table(table)) == as_text(want.union(wide))
    spark.sql(f"DROP TABLE {table}__before")
    assert as_text(spark.table(table)) == as_text(want.union(wide))
    # Once more: the partitions now lie where the first table had them.
    again = wide.withColumn("k", F.lit(1)).withColumn("n", F.lit(1))
    assert migrate(spark, table, again.schema, mode=WIDE).of("add") == ["k", "n"]
    more = again.withColumn("n", F.lit(1).cast("long"))
    assert migrate(spark, table, more.schema, mode=WIDE).of("widen") == ["n"]
    assert gated_load(more, table, DELTA, type_mode=WIDE).written
    assert spark.table(table).count() == 12


@pytest.mark.parametrize("external, cluster", [(False, ()), (True, ("id",)), (False, ("id",))])
def test_widen_rewrites_where_files_cannot_stay(spark, table, external, cluster):
    df = made(spark, table, external, cluster=cluster)
    wide = df.withColumn("id", F.col("id").cast("long"))
    before = files_below(spark, table)
    assert migrate(spark, table, wide.schema, mode=WIDE).of("widen") == ["id"]
    assert not files_below(spark, table) & before
    assert as_text(spark.table(table)) == as_text(wide)
    assert describe_target(spark, f"spark_catalog.{table}").cluster_columns == cluster
    assert spark.table(table).where("id = 1").count() == 2
    assert gated_load(wide, table, DELTA, type_mode=WIDE).written
    assert as_text(spark.table(table)) == as_text(wide.union(wide))
    assert as_text(spark.table(f"{table}__before")) == as_text(df)
    spark.sql(f"DROP TABLE {table}__before")
    assert as_text(spark.table(table)) == as_text(wide.union(wide))


def test_relocate(spark, table):
    df = made(spark, table, cluster=("id",))
    plan = migrate(spark, table, df.schema, ["s", "d"], ["x", "s"], WIDE)
    assert [s.action for s in plan.steps] == ["relocate", "relocate"]
    target = describe_target(spark, f"spark_catalog.{table}", WIDE)
    assert (target.partition_columns, target.cluster_columns) == (("s", "d"), ("x",))
    assert as_text(spark.table(table)) == as_text(df)
    assert gated_load(df, table, DELTA, ["s", "d"], ["x", "s"], type_mode=WIDE).written
    assert migrate(spark, table, df.schema, ["s", "d"], ["x", "s"], WIDE).steps == ()


def test_convert_leaves_the_target_alone(spark, table):
    wide = made(spark, table, schema="id int, x double, s string, d string")
    narrow = wide.withColumn("x", F.col("x").cast("float"))
    plan = migrate(spark, table, narrow.schema, mode=STRICT)
    # In mode strict a double is no known type, so nothing helps; wide lets it in as it is.
    assert [r.reason for r in plan.refused] != [] and not plan.of("widen")
    assert migrate(spark, table, narrow.schema, mode=WIDE).steps == ()
    longs = f"{table}_longs"
    df = made(spark, longs, schema="id int, x decimal(20,2), s string, d string",
              data=[(1, None, "a", "p")])
    ints = df.withColumn("x", F.lit(7))
    plan = migrate(spark, longs, ints.schema)
    assert [str(s) for s in plan.steps] == ["convert x decimal(20,2)"]
    assert gated_load(converted(ints, plan), longs, DELTA).written


def test_create(spark, table):
    df = spark.createDataFrame(DATA, SCHEMA)
    plan = migrate(spark, table, df.schema, ["d"], ["id"], buckets=2, path=fresh_path(spark, "made"))
    assert [s.action for s in plan.steps] == ["create"]
    assert gated_load(df, table, DELTA, ["d"], ["id"]).written


REFUSED = [
    ("id string, x float, s string, d string", {}, STRICT, "neither int nor string"),
    ("id bigint, x float, s string, d string", {}, STRICT, "mode strict does not know bigint"),
    ("ID int, x float, s string, d string", {}, STRICT, "differs from id in case only"),
    ("id int, x float, s string", {}, STRICT, "no partition"),
    ("id int, x float, s string, d string, m map<string,int>", {}, WIDE, "does not know map"),
    ("id int, x float, s string, d string", {"partition_columns": ["zz"]}, WIDE, "neither frame nor target has zz"),
    ("id int, x float, s string, d string", {"partition_columns": ["d", "id", "x", "s", "extra"]}, WIDE, "no column would be left"),
]


@pytest.mark.parametrize("schema, layout, mode, reason", REFUSED)
def test_refusals_change_nothing(spark, table, schema, layout, mode, reason):
    df = made(spark, table)
    before = (spark.table(table).schema, files_below(spark, table))
    frame = T.StructType.fromDDL(f"{schema}, extra string")  # a step that would be possible
    plan = migrate(spark, table, frame, mode=mode, **layout)
    assert [r.reason for r in plan.refused if reason in r.reason]
    assert (spark.table(table).schema, files_below(spark, table)) == before
    assert as_text(spark.table(table)) == as_text(df)


def test_every_finding_is_planned_or_refused(spark):
    kinds = ["int", "bigint", "float", "double", "string", "date", "timestamp", "timestamp_ntz",
             "decimal(9,2)", "decimal(20,2)", "boolean", "smallint", "binary"]
    for mode in (STRICT, WIDE):
        for held in kinds:
            for sent in [*kinds, None]:
                target_schema = T.StructType.fromDDL(f"a {held}, p string")
                fields = {f.name: f.dataType for f in target_schema}
                from stammwerk.operators.gate import warehouse_type

                target = Target("t", {n: warehouse_type(k, mode) or k.simpleString().upper() for n, k in fields.items()},
                                ("p",), (), fields)
                schema = T.StructType.fromDDL("p string" + (f", a {sent}" if sent else ", b int"))
                bad = [f for f in check_frame(schema, target, ["p"], None, mode) if not f.ok]
                plan = plan_migration(schema, target, ["p"], None, mode)
                assert len(plan.steps) + len(plan.refused) == len(bad)
                if plan.refused:
                    continue
                for step in plan.steps:  # the gate lets the migrated pair through
                    if step.action == "convert":
                        schema = T.StructType([T.StructField(f.name, fields[f.name]) for f in schema])
                    else:
                        fields = fields | {step.field: schema[step.field].dataType}
                after = Target("t", {n: warehouse_type(k, mode) or k.simpleString().upper() for n, k in fields.items()},
                               ("p",), (), fields)
                assert passes(check_frame(schema, after, ["p"], None, mode)), (mode, held, sent)


def test_wider_types_hold_all_values(spark):
    ints = [-(2**31), 2**31 - 1, 0]
    for kind in ("bigint", "double", "decimal(12,2)"):
        assert holds_all(T.IntegerType(), T.StructType.fromDDL(f"a {kind}")["a"].dataType)
        df = spark.createDataFrame([(i,) for i in ints], "a int")
        assert [r.a for r in df.select(F.col("a").cast(kind).cast("int").alias("a")).collect()] == ints
    assert not holds_all(T.IntegerType(), T.DecimalType(11, 2))
    assert not holds_all(T.LongType(), T.DoubleType()) and not holds_all(T.IntegerType(), T.FloatType())
    assert math.isfinite(spark.sql("SELECT CAST(CAST(1e-40 AS FLOAT) AS DOUBLE)").first()[0])


@pytest.mark.parametrize("dies_at", [0, 1, 2])
def test_a_migration_that_died_is_repeated(spark, table, monkeypatch, dies_at):
    df = made(spark, table)
    wide = df.withColumn("id", F.col("id").cast("long"))
    calls, rename, stage = [], migration._rename, migration._stage

    def failing_rename(*args):
        calls.append(args)
        if len(calls) == dies_at:
            raise RuntimeError("died")
        rename(*args)

    def failing_stage(*args):
        stage(*args)
        if dies_at == 0:
            raise RuntimeError("died")

    monkeypatch.setattr(migration, "_rename", failing_rename)
    monkeypatch.setattr(migration, "_stage", failing_stage)
    with pytest.raises(RuntimeError, match="died"):
        migrate(spark, table, wide.schema, mode=WIDE)
    monkeypatch.undo()
    migrate(spark, table, wide.schema, mode=WIDE)
    assert spark.table(table).schema["id"].dataType == T.LongType()
    assert as_text(spark.table(table)) == as_text(wide)
    assert not spark.catalog.tableExists(f"{table}__next")


def test_empty_table_and_partition_names(spark, table):
    made(spark, table)
    found = partition_locations(spark, f"spark_catalog.{table}", ["d"])
    assert len(found) == 3 and any("null" in spec for spec, _ in found)
    empty = f"{table}_empty"
    df = made(spark, empty, data=[])
    migrate(spark, empty, df.withColumn("id", F.col("id").cast("long")).schema, mode=WIDE)
    assert rows(spark.table(empty)) == [] and spark.table(empty).schema["id"].dataType == T.LongType()
