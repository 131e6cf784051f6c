"""Totals of the wide table over several groupings at once, with exact distinct counts.

Rows are first reduced to one per finest group and counted key, which a task does before anything
is shuffled and which spreads a group with a third of all rows over its keys. They are then
gathered by ranges of the key and only there copied for each grouping set: a set's distinct keys
are bits, built one group of a range after the other. Bits are counted where they are built
and neither shuffled nor sorted, so thinly spread ids cost no more than dense ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = "rows"
DISTINCT = "distinct"
GROUPING = "grouping"
_RANGE_BITS = 10  # neighbouring keys of a range, as a power of two


def roll_up(
    rows: DataFrame,
    groups: Sequence[str],
    grouping_sets: Sequence[Sequence[str]],
    counted: str,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Row counts, sums and distinct ``counted`` keys for each of the grouping sets.

    Columns: all ``groups`` (null where a set leaves one out), ``grouping`` (bits of the
    left-out columns, the last column lowest, as by SQL's grouping_id), ``rows``,
    ``distinct`` and the sums. The empty set is the grand total; on an empty table it is no
    row. A null group is a group of its own, told from a left-out one by ``grouping``. Null
    keys are no keys; ``counted`` is an integer of any sign.
    """
    unknown = sorted({c for s in grouping_sets for c in s} - set(groups))
    if unknown:
        raise ValueError(f"{unknown} are not among the groups")
    names = list(sums or {})
    by_key = _per_key(rows, groups, counted, sums)
    sets = [
        F.struct(
            F.lit(sum(1 << (len(groups) - 1 - i) for i, g in enumerate(groups) if g not in s)).alias(GROUPING),
            *[(F.col(g) if g in s else F.lit(None).cast(rows.schema[g].dataType)).alias(g) for g in groups],
        )
        for s in grouping_sets
    ]
    # With as many more parts as there are sets, a task holds no more rows than without the copies.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * max(len(sets), 1)
    gathered = by_key.withColumn("_range", F.shiftright("_key", _RANGE_BITS)).repartition(parts, "_range")
    expanded = gathered.select(F.explode(F.array(*sets)).alias("_set"), "_range", "_key", ROWS, *names)
    added = [F.sum(c).alias(c) for c in (ROWS, *names)]
    bit = F.col("_key").bitwiseAND((1 << _RANGE_BITS) - 1)
    by_range = expanded.select("_set.*", "_range", bit.alias("_bit"), ROWS, *names).groupBy(
        *groups, GROUPING, "_range"
    ).agg(F.bitmap_count(F.bitmap_construct_agg("_bit")).alias(DISTINCT), *added)
    totals = by_range.groupBy(*groups, GROUPING).agg(F.sum(DISTINCT).cast("long").alias(DISTINCT), *added)
    return totals.select(*groups, GROUPING, ROWS, DISTINCT, *names)


def _per_key(rows: DataFrame, groups: Sequence[str], counted: str, sums: Mapping[str, Column] | None) -> DataFrame:
    """Row count and sums per finest group and key; null keys are one key without a bit."""
    totals = [F.sum(column).alias(name) for name, column in (sums or {}).items()]
    return rows.groupBy(*groups, F.col(counted).cast("long").alias("_key")).agg(F.count(F.lit(1)).alias(ROWS), *totals)


def cube_sets(groups: Sequence[str]) -> list[list[str]]:
    """All subsets of the groups, the whole set first."""
    return [
        [g for i, g in enumerate(groups) if not bits >> (len(groups) - 1 - i) & 1] for bits in range(1 << len(groups))
    ]


def rollup_sets(groups: Sequence[str]) -> list[list[str]]:
    """The groups, then without the last one, and so on to the grand total."""
    return [list(groups[:n]) for n in range(len(groups), -1, -1)]
