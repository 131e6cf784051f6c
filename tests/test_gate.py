import pytest

from stammwerk.operators.gate import (
    Target,
    check_frame,
    describe_target,
    findings_frame,
    passes,
    warehouse_type,
)


def failures(schema, target, *layout, **options):
    return [(f.check, f.field) for f in check_frame(schema, target, *layout, **options) if not f.ok]


@pytest.fixture
def schema(spark):
    def make(ddl):
        return spark.createDataFrame([], ddl).schema

    return make


def test_all_findings_are_listed(schema):
    target = Target("t", {"depot": "STRING", "floors": "INTEGER", "opened": "DATE", "district": "INTEGER"})
    frame = schema("depot string, floors int, opened date, river string, district string")
    assert failures(frame, target) == [("field_exists", "river"), ("type", "district")]


@pytest.mark.parametrize(
    "held, taken, fits",
    [("int", "bigint", False), ("bigint", "int", True), ("float", "double", False),
     ("double", "float", True), ("bigint", "bigint", True)],
)
def test_wide_only_widens(spark, schema, held, taken, fits):
    name = f"default.held_{held}_{taken}"
    spark.createDataFrame([], f"c {held}").write.mode("overwrite").saveAsTable(name)
    assert passes(check_frame(schema(f"c {taken}"), describe_target(spark, name, "wide"), mode="wide")) is fits


def test_time_zones_are_listed(spark, schema):
    spark.createDataFrame([], "c timestamp").write.mode("overwrite").saveAsTable("default.zoned")
    found = check_frame(schema("c timestamp_ntz"), describe_target(spark, "default.zoned", "wide"), mode="wide")
    assert ("time_zone", True) in [(f.check, f.ok) for f in found]


@pytest.mark.parametrize(
    "spark_type, warehouse, strict, wide",
    [
        ("string", "STRING", True, True),
        ("int", "INTEGER", True, True),
        ("bigint", "INTEGER", False, True),
        ("float", "FLOAT", True, True),
        ("double", "FLOAT", False, True),
        ("boolean", "BOOLEAN", True, True),
        ("date", "DATE", True, True),
        ("timestamp", "TIMESTAMP", True, True),
        ("timestamp_ntz", "TIMESTAMP", False, True),
        ("decimal(10,2)", "NUMERIC", True, True),
        ("decimal(38,9)", "NUMERIC", True, True),
        ("string", "DATE", False, False),
        ("string", "GEOGRAPHY", False, False),
        ("array<int>", "INTEGER", False, False),
        ("binary", "BYTES", False, False),
    ],
)
def test_types(schema, spark_type, warehouse, strict, wide):
    frame, target = schema(f"c {spark_type}"), Target("t", {"c": warehouse})
    assert passes(check_frame(frame, target)) is strict
    assert passes(check_frame(frame, target, mode="wide")) is wide


def test_names_are_case_sensitive_and_further_target_fields_pass(schema):
    target = Target("t", {"PARTID": "INTEGER", "more": "STRING"})
    assert failures(schema("PARTID int"), target) == []
    assert failures(schema("partid int"), target) == [("field_exists", "partid")]


def test_partition_field(schema):
    target = Target("t", {"a": "INTEGER", "d": "DATE"}, ("d",))
    frame = schema("a int, d date")
    assert failures(frame, target) == []
    assert failures(frame, target, ["d"]) == []
    assert failures(frame, target, ["a"]) == [("partition_columns", "")]
    assert failures(schema("a int"), target) == [("partition_field", "d")]
    plain = Target("t", {"a": "INTEGER", "d": "DATE"})
    assert failures(frame, plain, ["a"]) == []


def test_cluster_fields(schema):
    target = Target("t", {"a": "INTEGER", "b": "INTEGER"}, (), ("a", "b"))
    frame = schema("a int, b int")
    assert failures(frame, target, None, ["b", "a"]) == []
    assert failures(frame, target, None, ["a"]) == [("cluster_columns", "")]
    assert failures(frame, target, None, []) == [("cluster_columns", "")]
    assert failures(frame, target) == []
    assert failures(frame, Target("t", {"a": "INTEGER", "b": "INTEGER"}), None, ["a"]) == []


def test_missing_target(spark, schema):
    assert describe_target(spark, "default.nowhere") is None
    assert failures(schema("a int"), None) == [("target_exists", "")]


def test_target_description(spark):
    frame = spark.createDataFrame([], "a int, b bigint, c string, d date")
    frame.write.partitionBy("d").bucketBy(2, "a", "c").mode("overwrite").saveAsTable("described")
    strict = describe_target(spark, "default.described")
    assert strict.fields == {"a": "INTEGER", "b": "BIGINT", "c": "STRING", "d": "DATE"}
    assert strict.partition_columns == ("d",)
    assert set(strict.cluster_columns) == {"a", "c"}
    assert describe_target(spark, "default.described", "wide").fields["b"] == "INTEGER"
    assert describe_target(spark, f"{spark.catalog.currentCatalog()}.default.described") is not None


def test_findings_as_a_frame(spark, schema):
    findings = check_frame(schema("a int, b int"), Target("t", {"a": "INTEGER"}))
    frame = findings_frame(spark, findings)
    assert frame.where("NOT ok").select("check", "field").collect() == [("field_exists", "b")]
    assert frame.count() == 3


def test_unknown_types_have_no_name(spark):
    assert warehouse_type(spark.createDataFrame([], "m map<string,int>").schema["m"].dataType) is None
