"""Schema gate: does a frame fit the table it is to be loaded into?"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STRICT = "strict"
WIDE = "wide"

# The warehouse types the gate knows and their Spark types.
STRICT_TYPES = {
    "STRING": (T.StringType,),
    "INTEGER": (T.IntegerType,),
    "FLOAT": (T.FloatType,),
    "BOOLEAN": (T.BooleanType,),
    "DATE": (T.DateType,),
    "TIMESTAMP": (T.TimestampType,),
    "NUMERIC": (T.DecimalType,),
}
WIDE_TYPES = STRICT_TYPES | {
    "INTEGER": (T.IntegerType, T.LongType),
    "FLOAT": (T.FloatType, T.DoubleType),
    "TIMESTAMP": (T.TimestampType, T.TimestampNTZType),
}
TYPE_MODES = {STRICT: STRICT_TYPES, WIDE: WIDE_TYPES}
# Types of one warehouse type, narrow to wide: a frame's may be narrower than the target's.
WIDTHS = ((T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))

FINDING_SCHEMA = "check string, field string, expected string, actual string, ok boolean"


@dataclass(frozen=True)
class Finding:
    check: str
    field: str
    expected: str
    actual: str
    ok: bool


@dataclass(frozen=True)
class Target:
    """A target as the gate sees it: types are warehouse type names.

    ``types`` are the Spark types behind them, where they are known.
    """

    name: str
    fields: dict[str, str]
    partition_columns: tuple[str, ...] = ()
    cluster_columns: tuple[str, ...] = ()
    types: Mapping[str, T.DataType] = dataclasses.field(default_factory=dict)


def warehouse_type(data_type: T.DataType, mode: str = STRICT) -> str | None:
    """The warehouse type of a Spark type, or None where the gate knows none."""
    for name, classes in TYPE_MODES[mode].items():
        if type(data_type) in classes:
            return name
    return None


def describe_target(spark: SparkSession, table: str, mode: str = STRICT) -> Target | None:
    """The target's fields, partition and cluster columns; None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    columns = spark.catalog.listColumns(table)
    fields = {
        f.name: warehouse_type(f.dataType, mode) or f.dataType.simpleString().upper()
        for f in spark.table(table).schema
    }
    return Target(
        table,
        fields,
        tuple(c.name for c in columns if c.isPartition),
        tuple(c.name for c in columns if c.isBucket),
        {f.name: f.dataType for f in spark.table(table).schema},
    )


def narrows(source: T.DataType, target: T.DataType) -> bool:
    """Whether ``target`` is the narrower of two types of one kind."""
    for order in WIDTHS:
        if type(source) in order and type(target) in order:
            return order.index(type(source)) > order.index(type(target))
    return False


def check_frame(
    schema: T.StructType,
    target: Target | None,
    partition_columns: Sequence[str] | None = None,
    cluster_columns: Sequence[str] | None = None,
    mode: str = STRICT,
) -> list[Finding]:
    """All findings, good and bad.

    In mode ``wide`` a type may become wider, never narrower. A timestamp without time
    zone that goes into one with, or the other way, passes and is listed as
    ``time_zone``, because the session's zone decides its value. Names are compared case-sensitively; the target may have further fields. Decimal
    precision and nullability do not count. Partition and cluster columns are
    compared with the target's only where it has some and the caller states them
    (None: not stated); cluster columns in any order.
    """
    if target is None:
        return [Finding("target_exists", "", "table", "missing", False)]
    findings = []
    for field in schema:
        expected = target.fields.get(field.name)
        actual = warehouse_type(field.dataType, mode)
        shown = actual or field.dataType.simpleString().upper()
        findings.append(
            Finding("field_exists", field.name, "present",
                    "present" if expected else "missing", expected is not None)
        )
        if expected:
            known = expected in TYPE_MODES[mode]
            kept = target.types.get(field.name)
            fits = known and expected == actual
            if fits and kept is not None and narrows(field.dataType, kept):
                expected, fits = kept.simpleString().upper(), False
                shown = field.dataType.simpleString().upper()
            findings.append(Finding("type", field.name, expected, shown, fits))
            zones = {type(field.dataType), type(kept)}
            if zones == {T.TimestampType, T.TimestampNTZType}:
                findings.append(
                    Finding("time_zone", field.name, kept.simpleString().upper(),
                            field.dataType.simpleString().upper(), True)
                )
    for column in target.partition_columns:
        there = column in schema.names
        findings.append(
            Finding("partition_field", column, "present", "present" if there else "missing", there)
        )
    if target.partition_columns and partition_columns:
        findings.append(
            _compared("partition_columns", target.partition_columns, partition_columns,
                      list(target.partition_columns) == list(partition_columns))
        )
    if target.cluster_columns and cluster_columns is not None:
        findings.append(
            _compared("cluster_columns", target.cluster_columns, cluster_columns,
                      set(target.cluster_columns) == set(cluster_columns))
        )
    return findings


def _compared(check: str, expected: Sequence[str], actual: Sequence[str], ok: bool) -> Finding:
    return Finding(check, "", ",".join(expected), ",".join(actual), ok)


def passes(findings: Sequence[Finding]) -> bool:
    return all(f.ok for f in findings)


def findings_frame(spark: SparkSession, findings: Sequence[Finding]) -> DataFrame:
    rows = [(f.check, f.field, f.expected, f.actual, f.ok) for f in findings]
    return spark.createDataFrame(rows, FINDING_SCHEMA)
