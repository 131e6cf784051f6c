"""Sinks: overwrite and append, partitioned and clustered, to tables and paths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stammwerk.plans.feeds import INITIAL, check_load_type


def resolve_target(spark: SparkSession, target: str) -> str:
    """``catalog.schema.table``; a two-part name gets the session's catalog."""
    parts = target.split(".")
    if len(parts) not in (2, 3) or not all(p.strip() for p in parts):
        raise ValueError(f"target must be schema.table or catalog.schema.table: {target!r}")
    if len(parts) == 2:
        parts.insert(0, spark.catalog.currentCatalog())
    if not spark.catalog.databaseExists(".".join(parts[:2])):
        raise ValueError(f"no schema {'.'.join(parts[:2])!r} for target {target!r}")
    return ".".join(parts)


def write_mode(load_type: str) -> str:
    return "overwrite" if check_load_type(load_type) == INITIAL else "append"


def bucket_columns(cluster: Sequence[str], partition: Sequence[str]) -> list[str]:
    """Cluster columns without partition columns, which Spark cannot bucket by."""
    return [c for c in cluster if c not in partition]


def _bucket_count(df: DataFrame, buckets: int | None) -> int:
    return buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _gather(df: DataFrame, columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """Bring rows of equal ``columns`` into few files.

    REBALANCE lets AQE cut an oversized group into several tasks and merge small
    ones, so one book date or one hot key does not become one task.
    """
    return df.hint("rebalance", *([parts] if parts else []), *columns)


def _table_buckets(spark: SparkSession, name: str) -> int:
    """The bucket count an existing table was made with."""
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    row = spark.sql(f"DESCRIBE EXTENDED {quoted}").where("col_name = 'Num Buckets'").first()
    return int(row.data_type)


def _check_columns(df: DataFrame, name: str, target: T.StructType) -> None:
    """Raise where a column would be lost: not in the target, or in another case only."""
    there = {f.name for f in target}
    folded = {f.name.lower(): f.name for f in target}
    extra = [c for c in df.columns if c not in there]
    cases = [f"{c} ({folded[c.lower()]})" for c in extra if c.lower() in folded]
    if cases:
        raise ValueError(f"columns that differ from those of {name} in case only: {cases}")
    if extra:
        raise ValueError(f"columns that {name} does not have: {extra}")


def create_target(
    spark: SparkSession,
    target: str,
    schema: T.StructType,
    partition_columns: Sequence[str] = (),
    cluster_columns: Sequence[str] = (),
    buckets: int | None = None,
    path: str | None = None,
    file_format: str = "parquet",
) -> str:
    """An empty target table with the given layout; below ``path`` if given."""
    name = resolve_target(spark, target)
    empty = spark.createDataFrame([], schema)
    writer = _laid_out(
        empty.write.format(file_format),
        partition_columns,
        bucket_columns(cluster_columns, partition_columns),
        _bucket_count(empty, buckets),
        bucket_columns(cluster_columns, partition_columns),
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def _laid_out(
    writer: DataFrameWriter, partition: Sequence[str], cluster: Sequence[str], buckets: int,
    sort: Sequence[str],
) -> DataFrameWriter:
    if partition:
        writer = writer.partitionBy(*partition)
    if cluster:
        writer = writer.bucketBy(buckets, *cluster).sortBy(*sort)
    return writer


def write_table(
    df: DataFrame,
    target: str,
    load_type: str,
    partition_columns: Sequence[str] = (),
    cluster_columns: Sequence[str] = (),
    buckets: int | None = None,
    gather: bool = True,
    replace_partition: Mapping[str, object] | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    sort_columns: Sequence[str] = (),
    gathered: bool = False,
) -> str:
    """Load ``df`` into a catalog table; returns its full name.

    ``initial`` replaces the whole content, whatever the session's overwrite mode;
    ``delta`` appends. An existing table keeps its layout and bucket count: columns go in by
    name, those ``df`` lacks become null, and columns the table lacks (or has in
    another case only) raise. A new table gets the stated layout; files are sorted by
    ``sort_columns`` or else the cluster columns. ``gather=False`` skips the shuffle by
    partition columns where they are constant within the load. ``gathered`` says that rows
    come out of a step that gathers them by the cluster columns; the shuffle by those is then
    skipped where there are as many buckets as shuffle partitions. ``replace_partition``
    names one partition, as in ``{"md_book_date": "2024-06-30"}``: all rows go there and
    replace only what it held, which makes a rerun of one book date safe. Rows that
    carry another value of such a column make the load fail.
    """
    spark = df.sparkSession
    mode = write_mode(load_type)
    name = resolve_target(spark, target)
    if not spark.catalog.tableExists(name):
        cluster = bucket_columns(cluster_columns, partition_columns)
        count = _bucket_count(df, buckets)
        if cluster and not (gathered and count == _bucket_count(df, None)):
            df = _gather(df, cluster, count)
        elif partition_columns and gather and not cluster:
            df = _gather(df, partition_columns)
        writer = _laid_out(
            df.write.format(file_format).mode(mode), partition_columns, cluster, count,
            list(sort_columns) or cluster,
        )
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
        return name

    columns = spark.catalog.listColumns(name)
    cluster = [c.name for c in columns if c.isBucket]
    partition = [c.name for c in columns if c.isPartition]
    schema = spark.table(name).schema
    _check_columns(df, name, schema)
    static = replace_partition or {}
    for column in static:
        if column in df.columns:
            df = _only(df, column, static[column])
    count = _table_buckets(spark, name) if cluster else 0
    if cluster and not (gathered and count == _bucket_count(df, None)):
        df = _gather(df, cluster, count)
    elif partition and gather and not cluster:
        df = _gather(df, partition)
    aligned = df.select(
        [
            F.col(f"`{f.name}`")
            if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
            if f.name not in static
        ]
    )
    if static:
        spec = ", ".join(f"`{c}` = :{c}" for c in static)
        quoted = ".".join(f"`{part}`" for part in name.split("."))
        spark.sql(
            f"INSERT OVERWRITE TABLE {quoted} PARTITION ({spec}) SELECT * FROM {{rows}}",
            args=dict(static),
            rows=aligned,
        )
    else:
        dynamic = spark.conf.get(_OVERWRITE_MODE).lower() == "dynamic"
        if mode == "overwrite" and partition and dynamic:
            _replace_all(aligned, name)
        else:
            aligned.write.mode(mode).insertInto(name)
    return name


def _only(df: DataFrame, column: str, value: object) -> DataFrame:
    """``df``, failing when it runs on a row whose ``column`` is not ``value``."""
    stated = F.lit(value).cast(df.schema[column].dataType)
    message = F.concat(
        F.lit(f"{column} should be {value}, not "), F.coalesce(F.col(column).cast("string"), F.lit("null"))
    )
    checked = F.when(F.col(column).eqNullSafe(stated), F.col(column)).otherwise(
        F.raise_error(message).cast(df.schema[column].dataType)
    )
    return df.where(checked.isNotNull() | F.lit(value).isNull())


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _replace_all(aligned: DataFrame, name: str) -> None:
    """Overwrite every partition, also where the session's mode is dynamic.

    A table write takes the mode from its session only. The rows get a session of their
    own, a copy of the caller's, so nothing changes for what the caller writes meanwhile.
    """
    session = aligned._jdf.sparkSession().cloneSession()
    session.conf().set(_OVERWRITE_MODE, "static")
    rows = aligned._sc._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, aligned._jdf.logicalPlan())
    rows.write().mode("overwrite").insertInto(name)


def write_path(
    df: DataFrame,
    path: str,
    load_type: str,
    partition_columns: Sequence[str] = (),
    cluster_columns: Sequence[str] = (),
    gather: bool = True,
    replace_partitions: bool = False,
    file_format: str = "parquet",
) -> str:
    """Load ``df`` into files; clustering sorts the rows within each file."""
    mode = write_mode(load_type)
    if cluster_columns:
        df = _gather(df, cluster_columns).sortWithinPartitions(
            *partition_columns, *bucket_columns(cluster_columns, partition_columns)
        )
    elif partition_columns and gather:
        df = _gather(df, partition_columns)
    writer = df.write.format(file_format).mode("overwrite" if replace_partitions else mode)
    writer = writer.option("partitionOverwriteMode", "dynamic" if replace_partitions else "static")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.save(path)
    return path
