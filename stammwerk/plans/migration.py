"""From the gate's findings to a migrated target.

A finding that stops a load says that frame and target differ. Here every such finding becomes a
step of a plan, or is refused with a reason; a plan with a refusal changes nothing.

- ``add``: the target gets a column; its rows have null there. No file is touched.
- ``widen``: the target's column takes a type that holds all values of its old one. Spark reads
  the old Parquet files under the wider type, so the partitions of an external table are attached
  to the migrated one where they are. Files are written anew only where that is not enough: for a
  bucket column (another type has other hashes), a partition column, another file format, a
  managed or unpartitioned table.
- ``relocate``: other partition or cluster columns; all rows are written into the new layout.
- ``convert``: the frame's column is the narrower one; the frame is cast, the target stays.
- ``create``: there is no target yet.

What has to be staged is built completely beside the target, as ``<target>__next``, and published
by two renames, which leave the former table as ``<target>__before`` for the caller to drop. A run
that dies before the first rename has changed nothing, and one that dies between the two is
completed by the next call. Loads and migrations of one table go one at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stammwerk.operators.gate import (
    STRICT,
    Finding,
    Target,
    check_frame,
    describe_target,
    warehouse_type,
)
from stammwerk.plans.feeds import INITIAL
from stammwerk.session import fresh_path
from stammwerk.sinks.writers import bucket_columns, create_target, resolve_target, write_table

CREATE, ADD, WIDEN, RELOCATE, CONVERT = "create", "add", "widen", "relocate", "convert"
ORDER = (CREATE, ADD, WIDEN, RELOCATE, CONVERT)
NEXT, BEFORE = "__next", "__before"
# Fixed value: how the catalog spells a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Step:
    action: str
    field: str
    detail: str = ""

    def __str__(self) -> str:
        return " ".join(x for x in (self.action, self.field, self.detail) if x)


@dataclass(frozen=True)
class Refusal:
    finding: Finding
    reason: str


@dataclass(frozen=True)
class Migration:
    """Ordered steps, or the reasons why there can be none."""

    steps: tuple[Step, ...]
    refused: tuple[Refusal, ...]
    partition_columns: tuple[str, ...] = ()
    cluster_columns: tuple[str, ...] = ()

    def of(self, action: str) -> list[str]:
        return [s.field for s in self.steps if s.action == action]


def holds_all(narrow: T.DataType, wide: T.DataType) -> bool:
    """Whether ``wide`` has every value of ``narrow``, exactly, and Spark reads one as the other."""
    if isinstance(narrow, T.IntegerType):
        if isinstance(wide, T.DecimalType):
            return wide.precision - wide.scale >= 10
        return isinstance(wide, (T.LongType, T.DoubleType))
    return isinstance(narrow, T.FloatType) and isinstance(wide, T.DoubleType)


def plan_migration(
    schema: T.StructType,
    target: Target | None,
    partition_columns: Sequence[str] | None = None,
    cluster_columns: Sequence[str] | None = None,
    mode: str = STRICT,
) -> Migration:
    """A step or a refusal for each finding of ``check_frame`` that is not ok.

    After the steps a frame of ``schema``, converted, passes the gate in the same mode.
    """
    stated = None if cluster_columns is None else bucket_columns(cluster_columns, partition_columns or ())
    findings = [f for f in check_frame(schema, target, partition_columns, stated, mode) if not f.ok]
    steps, refused = [], []
    for finding in findings:
        found = _step(finding, schema, target, mode)
        (steps if isinstance(found, Step) else refused).append(found)
    partition = tuple(target.partition_columns if target else partition_columns or ())
    cluster = tuple(target.cluster_columns if target else stated or ())
    moved = {f.check: f for f in findings if f.check in ("partition_columns", "cluster_columns")}
    if "partition_columns" in moved:
        partition = tuple(partition_columns)
    if "cluster_columns" in moved:
        cluster = tuple(stated)
    if moved:
        there = {*target.fields, *schema.names}
        for finding in moved.values():
            reason = _no_layout(finding, partition, cluster, there)
            if reason:
                steps = [s for s in steps if s.field != finding.actual or s.action != RELOCATE]
                refused.append(Refusal(finding, reason))
    cluster = tuple(bucket_columns(cluster, partition))
    return Migration(tuple(sorted(steps, key=lambda s: ORDER.index(s.action))), tuple(refused), partition, cluster)


def _no_layout(finding: Finding, partition: Sequence[str], cluster: Sequence[str], there: set[str]) -> str | None:
    wanted = partition if finding.check == "partition_columns" else cluster
    absent = [c for c in wanted if c not in there]
    if absent:
        return f"neither frame nor target has {', '.join(absent)}"
    if there <= set(partition):
        return "no column would be left besides the partition columns"
    return None


def _step(finding: Finding, schema: T.StructType, target: Target | None, mode: str) -> Step | Refusal:
    if finding.check == "target_exists":
        unknown = [f.name for f in schema if warehouse_type(f.dataType, mode) is None]
        if unknown:
            return Refusal(finding, f"types that mode {mode} does not know: {', '.join(unknown)}")
        return Step(CREATE, "")
    if finding.check in ("partition_columns", "cluster_columns"):
        return Step(RELOCATE, finding.actual, finding.check)
    if finding.check == "partition_field":
        return Refusal(finding, "the frame's rows would have no partition")
    there = schema[finding.field].dataType
    shown = there.simpleString()
    known = warehouse_type(there, mode) is not None
    if finding.check == "field_exists":
        alike = [f for f in target.fields if f.lower() == finding.field.lower()]
        if alike:
            return Refusal(finding, f"differs from {alike[0]} in case only")
        if not known:
            return Refusal(finding, f"mode {mode} does not know {shown}")
        return Step(ADD, finding.field, shown)
    kept = target.types.get(finding.field)
    if kept is None:
        return Refusal(finding, "the target's type is not known")
    if holds_all(there, kept) and warehouse_type(kept, mode) is not None:
        return Step(CONVERT, finding.field, kept.simpleString())
    if holds_all(kept, there) and known:
        return Step(WIDEN, finding.field, shown)
    if holds_all(kept, there) or there == kept:
        return Refusal(finding, f"mode {mode} does not know {shown}")
    return Refusal(finding, f"neither {kept.simpleString()} nor {shown} holds all values of the other")


def migrate(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    partition_columns: Sequence[str] | None = None,
    cluster_columns: Sequence[str] | None = None,
    mode: str = STRICT,
    buckets: int | None = None,
    path: str | None = None,
) -> Migration:
    """Make ``target`` fit frames of ``schema``; returns what was done.

    A plan with a refusal is returned without any of its steps taken. ``path`` is for a target
    that has to be created; ``buckets`` for new cluster columns (an existing count is kept).
    Rows, partitions and nulls of the target stay as they are, an empty table stays empty.
    """
    name = resolve_target(spark, target)
    _complete(spark, name)
    plan = plan_migration(schema, describe_target(spark, name, mode), partition_columns, cluster_columns, mode)
    if plan.refused or not plan.steps:
        return plan
    if plan.of(CREATE) == [""]:
        create_target(spark, name, schema, plan.partition_columns, plan.cluster_columns, buckets, path)
        return plan
    added = [schema[c] for c in plan.of(ADD)]
    if not plan.of(WIDEN) and not plan.of(RELOCATE):
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {_quoted(name)} ADD COLUMNS ({columns})")
        return plan
    if spark.catalog.tableExists(name + BEFORE):
        raise ValueError(f"drop {name + BEFORE}, which an earlier migration left, before the next one")
    _stage(spark, name, schema, plan, buckets)
    _rename(spark, name, name + BEFORE)
    _rename(spark, name + NEXT, name)
    return plan


def converted(df: DataFrame, plan: Migration) -> DataFrame:
    """``df`` with the columns cast that the plan casts in the frame."""
    kinds = {s.field: s.detail for s in plan.steps if s.action == CONVERT}
    return df.select([F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def _stage(spark: SparkSession, name: str, schema: T.StructType, plan: Migration, buckets: int | None) -> None:
    former = spark.table(name)
    facts = _facts(spark, name)
    widened = {c: schema[c].dataType for c in plan.of(WIDEN)}
    fields = [T.StructField(f.name, widened.get(f.name, f.dataType)) for f in former.schema]
    fields += [T.StructField(c, schema[c].dataType) for c in plan.of(ADD)]
    external = facts.get("Type") == "EXTERNAL"
    path = fresh_path_beside(spark, facts["Location"]) if external else None
    held = int(facts.get("Num Buckets", 0))
    keys = {*plan.partition_columns, *plan.cluster_columns}
    stays = external and facts.get("Provider") == "parquet" and plan.partition_columns
    stays = stays and not plan.of(RELOCATE) and not keys & set(widened)
    layout = (plan.partition_columns, plan.cluster_columns, held or buckets, path)
    file_format = facts.get("Provider", "parquet")
    create_target(spark, name + NEXT, T.StructType(fields), *layout, file_format=file_format)
    if stays:
        for spec, location in partition_locations(spark, name, plan.partition_columns):
            spark.sql(f"ALTER TABLE {_quoted(name + NEXT)} ADD PARTITION ({spec}) LOCATION {_text(location)}")
        return
    rows = former.select(
        [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in former.columns
         else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    )
    write_table(rows, name + NEXT, INITIAL)


def fresh_path_beside(spark: SparkSession, location: str) -> str:
    """A folder next to ``location``: the same file system and permissions."""
    unused = fresh_path(spark, "next").rsplit("-", 1)[1]
    return f"{location.rstrip('/')}__{unused}"


def partition_locations(spark: SparkSession, name: str, columns: Sequence[str]) -> list[tuple[str, str]]:
    """(partition as SQL, folder) of each partition, from the catalog alone."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {_quoted(name)}").collect():
        values = dict(part.split("=", 1) for part in row.partition.split("/"))
        spec = ", ".join(
            f"`{c}` = null" if values[c] in (NULL_PARTITION, "null") else f"`{c}` = {_text(unquote(values[c]))}"
            for c in columns
        )
        about = spark.sql(f"DESCRIBE EXTENDED {_quoted(name)} PARTITION ({spec})")
        found.append((spec, about.where("col_name = 'Location'").first().data_type))
    return found


def _complete(spark: SparkSession, name: str) -> None:
    """Finish a publish that died between its renames; drop what died before them."""
    if not spark.catalog.tableExists(name + NEXT):
        return
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(name + BEFORE):
        _rename(spark, name + NEXT, name)
    else:  # an external table's files stay, so attached partitions are safe
        spark.sql(f"DROP TABLE {_quoted(name + NEXT)}")


def _facts(spark: SparkSession, name: str) -> dict[str, str]:
    found = [(r.col_name, r.data_type) for r in spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").collect()]
    start = max(i for i, (key, _) in enumerate(found) if key == "# Detailed Table Information")
    return dict(found[start:])  # the table's own lines come after its columns


def _rename(spark: SparkSession, name: str, to: str) -> None:
    """Rename a table; the files of a managed one move, and so do its partitions.

    Not every catalog notes where the partitions of a managed table have gone.
    """
    facts = _facts(spark, name)
    keys = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    managed = facts.get("Type") == "MANAGED" and keys
    moved = partition_locations(spark, name, keys) if managed else []
    spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(to.split('.', 1)[1])}")
    root = _facts(spark, to)["Location"]
    for spec, location in moved:
        if location.startswith(facts["Location"] + "/"):
            there = _text(root + location[len(facts["Location"]):])
            spark.sql(f"ALTER TABLE {_quoted(to)} PARTITION ({spec}) SET LOCATION {there}")


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
