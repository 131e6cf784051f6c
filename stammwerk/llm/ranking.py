"""Exact ranks by parallel sorting by regular sampling.

1. Every task sorts its rows: a locally sorted run, stored with each row's place in it.
2. Rows at regular places of all runs are the samples; sorted, they give regular splitters.
3. A row's segment follows from the splitters. Segment sizes alone say where each segment's
   ranks begin (prefix counts), so segments beyond the wanted ranks are never exchanged.
4. The other segments are exchanged, and merged where they arrive.

The last part of the sort key is a row's place in its run, so equal rows, however many, are
split like others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import stored

# Samples that reach the driver, besides at most one per run.
SAMPLES = 65_536
# Rows of a segment that a task merges, where there are more of them than shuffle partitions.
SEGMENT_ROWS = 2_000_000
_PLACE_BITS = 33  # of monotonically_increasing_id, below the task's number


def _segments(splitters: np.ndarray) -> Callable:
    """Adds each row's segment: the number of splitters that sort before it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.stack([
                pc.negate(batch.column("_score")).to_numpy(zero_copy_only=False),
                batch.column("_no_id").cast(pa.int64()).to_numpy(zero_copy_only=False),
                batch.column("_id").to_numpy(zero_copy_only=False),
                batch.column("_run").to_numpy(zero_copy_only=False),
                batch.column("_place").to_numpy(zero_copy_only=False),
            ])
            both = np.concatenate([splitters, keys], axis=1)
            order = np.lexsort(both[::-1])  # stable: a splitter goes before its equal
            passed = np.cumsum(order < splitters.shape[1])
            segment = np.empty(len(order), np.int64)
            segment[order] = passed
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(segment[splitters.shape[1] :], pa.int32())],
                names=[*batch.schema.names, "_segment"],
            )

    return run


def _numbered(begins: dict[int, int], limit: int) -> Callable:
    """Ranks of the sorted rows of whole segments; null beyond ``limit``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, at = -1, 0
        for batch in batches:
            ranks = np.empty(batch.num_rows, np.int64)
            owners = batch.column("_segment").to_numpy()
            starts = np.flatnonzero(np.diff(owners, prepend=segment))
            for start, stop in zip([0, *starts], [*starts, batch.num_rows]):
                if stop > start:
                    if owners[start] != segment:
                        segment, at = int(owners[start]), begins[int(owners[start])]
                    ranks[start:stop] = np.arange(at + 1, at + 1 + stop - start)
                    at += stop - start
            rank = pa.array(ranks, mask=ranks > limit)
            yield pa.RecordBatch.from_arrays([*batch.columns, rank], names=[*batch.schema.names, "_rank"])

    return run


def rank_highest(
    rows: DataFrame, score: str, id_column: str, limit: Column, eligible: str, rank: str = "rank"
) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... for the highest scores among ``eligible`` rows.

    ``score`` and ``id_column`` are longs; ties go to the smaller id, no id last. ``limit`` is
    an aggregate over the eligible rows that says how many get a rank; the others, and rows
    that are not eligible, keep a null. A null score counts as the lowest. Repeated rows all get ranks of their
    own. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    columns = rows.columns
    keyed = rows.select(
        *columns,
        F.coalesce(F.col(score), F.lit(-(1 << 62))).alias("_score"),
        F.col(id_column).isNull().alias("_no_id"),
        F.coalesce(F.col(id_column), F.lit(0)).cast("long").alias("_id"),
        F.coalesce(F.col(eligible), F.lit(False)).alias("_eligible"),
    ).sortWithinPartitions(F.desc("_eligible"), F.desc("_score"), "_no_id", "_id")
    number = F.monotonically_increasing_id()
    runs = stored(
        keyed.withColumn("_run", F.shiftright(number, _PLACE_BITS))
        .withColumn("_place", number.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))),
        "runs",
    )
    ranked = runs.where("_eligible")
    n, wanted = ranked.agg(F.count(F.lit(1)), limit.cast("long")).first()
    if not n or not wanted:
        return runs.select(*columns, F.lit(None).cast("long").alias(rank))

    stride = -(-n // SAMPLES)
    samples = ranked.where(F.col("_place") % stride == stride // 2).select(
        F.negative("_score"), F.col("_no_id").cast("long"), "_id", "_run", "_place"
    )
    keys = np.array(samples.collect(), np.int64).reshape(-1, 5)
    keys = keys[np.lexsort(keys.T[::-1])]
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SEGMENT_ROWS))
    at = np.unique(np.arange(1, pieces) * len(keys) // pieces)
    splitters = keys[at[at < len(keys)]].T

    extra = "_segment int"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in runs.schema)
    dealt = ranked.mapInArrow(_segments(splitters), f"{schema}, {extra}")
    sizes = dict(dealt.groupBy("_segment").count().collect())
    order = sorted(sizes)
    begins = dict(zip(order, accumulate([sizes[s] for s in order], initial=0)))
    reached = [s for s in order if begins[s] < wanted]
    # Segments are numbered in order, so those that hold ranks come first.
    merged = (
        dealt.where(F.col("_segment") <= reached[-1])
        .repartitionById(reached[-1] + 1, F.col("_segment"))
        .sortWithinPartitions(F.desc("_score"), "_no_id", "_id", "_run", "_place")
        .mapInArrow(_numbered(begins, wanted), f"{schema}, {extra}, _rank long")
    )
    beyond = dealt.where(F.col("_segment") > reached[-1]).withColumn("_rank", F.lit(None).cast("long"))
    others = runs.where("NOT _eligible").withColumn("_rank", F.lit(None).cast("long"))
    shown = [*columns, F.col("_rank").alias(rank)]
    return merged.select(shown).union(beyond.select(shown)).union(others.select(shown))
