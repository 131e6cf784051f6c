"""Current rows kept up to date by a stream of arriving files.

Files with versions are read as a stream, in micro-batches, until none is left. The state is the
stored current rows of :mod:`stammwerk.plans.current_store`: each batch refreshes the buckets its
keys fall into. The number of the batch, the newest change date and the counts are published
in the same operation as the rows, so a batch that is delivered again after a failure is
recognised and changes nothing. Where the stream stands is kept in a checkpoint in the shared
folder.

With a ``horizon`` the state forgets: a version that is older than the newest change date of
earlier batches by more than that is not merged but set aside in ``<view>_expired``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.operators.versions import CHANGE_DATE, current_rows, gather_columns
from stammwerk.plans.current_store import build_current, published_properties, refresh_current
from stammwerk.plans.feeds import DELTA
from stammwerk.session import remove, stored_at
from stammwerk.sinks.writers import write_table

BATCH = "_batch"
_BATCH, _MARK = "stammwerk.batch", "stammwerk.mark"
_COUNTS = ("rows", "late", "expired")


@dataclass(frozen=True)
class StreamState:
    """How far a stream has come: the last batch, the newest change date, rows so far.

    ``late`` rows were older than the row their key had; ``expired`` ones were set aside.
    """

    batch: int
    mark: str | None
    rows: int
    late: int
    expired: int


@dataclass(frozen=True)
class CurrentStream:
    """A view of current rows and how arriving versions get into it."""

    view: str
    keys: tuple[str, ...]
    bucket_by: tuple[str, ...]
    tie_break: tuple[str, ...] | None = None
    changed: str = CHANGE_DATE
    # An SQL interval such as "3 days"; None keeps every key for ever.
    horizon: str | None = None
    buckets: int | None = None

    @property
    def expired(self) -> str:
        return f"{self.view}_expired"


def stream_state(spark: SparkSession, view: str) -> StreamState:
    if not spark.catalog.tableExists(view):
        return StreamState(-1, None, 0, 0, 0)
    said = published_properties(spark, view)
    counts = [int(said.get(f"stammwerk.{c}", 0)) for c in _COUNTS]
    return StreamState(int(said.get(_BATCH, -1)), said.get(_MARK), *counts)


def _too_old(stream: CurrentStream, rows: DataFrame, mark: str | None) -> Column:
    if stream.horizon is None or mark is None:
        return F.lit(False)
    kind = rows.schema[stream.changed].dataType
    bound = F.lit(mark).cast(kind) - F.expr(f"INTERVAL {stream.horizon}")
    return F.coalesce(F.col(stream.changed) < bound, F.lit(False))


def _late(stream: CurrentStream, rows: DataFrame) -> int:
    """How many rows are older than the row their key has."""
    keys = [f"_k{i}" for i in range(len(stream.keys))]
    before = rows.sparkSession.table(stream.view).select(
        *[F.col(k).alias(n) for k, n in zip(stream.keys, keys)], F.col(stream.changed).alias("_has")
    )
    same = F.lit(True)
    for k, n in zip(stream.keys, keys):
        same = same & F.col(k).eqNullSafe(F.col(n))
    return rows.join(before, same).where(F.col(stream.changed) < F.col("_has")).count()


def take_batch(stream: CurrentStream, batch: DataFrame, number: int) -> None:
    """Merge one micro-batch; a batch that was merged before is left alone."""
    spark = batch.sparkSession
    state = stream_state(spark, stream.view)
    if number <= state.batch:
        return
    path, rows = stored_at(batch, "batch")
    old = _too_old(stream, rows, state.mark)
    aside, fit = rows.where(old), rows.where(~old)
    n, gone, newest = rows.agg(
        F.count(F.lit(1)), F.count(F.when(old, 1)), F.max(stream.changed).cast("string")
    ).first()
    if gone:
        marked = aside.withColumn(BATCH, F.lit(number))
        if spark.catalog.tableExists(stream.expired):
            write_table(marked, stream.expired, DELTA, replace_partition={BATCH: number})
        else:
            write_table(marked, stream.expired, DELTA, [BATCH], gather=False)
    first = state.batch < 0
    late = 0 if first else _late(stream, fit)
    kind = rows.schema[stream.changed].dataType
    mark = spark.range(1).select(
        F.greatest(F.lit(state.mark).cast(kind), F.lit(newest).cast(kind)).cast("string")
    ).first()[0] if state.mark or newest else None
    said = {
        _BATCH: str(number), "stammwerk.rows": str(state.rows + n), "stammwerk.late": str(state.late + late),
        "stammwerk.expired": str(state.expired + gone),
    } | ({_MARK: mark} if mark else {})
    tie_break = None if stream.tie_break is None else list(stream.tie_break)
    gather_by = gather_columns(stream.bucket_by, stream.keys)
    if first:
        current = current_rows(fit, stream.keys, tie_break, stream.changed, gather_by)
        build_current(current, stream.view, stream.bucket_by, stream.buckets, properties=said, gathered=True)
    else:
        refresh_current(
            fit, stream.view, stream.keys, stream.bucket_by, properties=said, gathered=True,
            tie_break=tie_break, changed=stream.changed, gather_by=gather_by,
        )
    remove(spark, path)


def run_stream(
    spark: SparkSession,
    stream: CurrentStream,
    path: str,
    schema: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    file_format: str = "parquet",
) -> StreamState:
    """Take in all files that are in ``path`` and were not read before; returns the state.

    ``schema`` is that of the files, ``checkpoint`` a folder that belongs to this stream and
    that all machines reach. Run again, it goes on where it stopped.
    """
    source = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    query = (
        source.load(path)
        .writeStream.foreachBatch(lambda batch, number: take_batch(stream, batch, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream_state(spark, stream.view)
