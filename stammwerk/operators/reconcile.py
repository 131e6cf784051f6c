"""Do two tables hold the same rows, and if not, where do they differ?

Every row has a digest; digests are added up, so the order of rows does not matter and a
double counts twice. Sums are kept per range of the first key column, in one aggregation of
each table, and added up further into a tree of ranges. Tables whose roots agree have been read
once. Else only the ranges whose leaves differ are read again, with the range as a filter the
scan can use, and compared row by row: what remains of ``EXCEPT ALL`` in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAN_OUT = 16
LEVELS = 2  # below the root
ONLY_LEFT, ONLY_RIGHT = "left", "right"
# Holds a sum of 64-bit digests whole, for 10 ** 18 rows.
_SUM = "decimal(38,0)"


@dataclass(frozen=True)
class Ranges:
    """Ranges of a column: below the first bound, from each bound to the next, and nulls."""

    column: str
    bounds: tuple

    def number(self) -> Column:
        """The range a row is in, found by halving; nulls are range -1."""
        key = F.col(f"`{self.column}`")

        def find(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(key < F.lit(self.bounds[middle]), find(low, middle)).otherwise(find(middle + 1, high))

        return F.when(key.isNull(), F.lit(-1)).otherwise(find(0, len(self.bounds)))

    def rows_of(self, numbers: Sequence[int]) -> Column:
        """A filter for some ranges, neighbours together, that a scan can use."""
        key = F.col(f"`{self.column}`")
        wanted, condition = sorted(n for n in numbers if n >= 0), F.lit(False)
        if -1 in numbers:
            condition = key.isNull()
        while wanted:
            first = last = wanted.pop(0)
            while wanted and wanted[0] == last + 1:
                last = wanted.pop(0)
            part = F.lit(True)
            if first > 0:
                part = part & (key >= F.lit(self.bounds[first - 1]))
            if last < len(self.bounds):
                part = part & (key < F.lit(self.bounds[last]))
            condition = condition | (part & key.isNotNull())
        return condition


@dataclass(frozen=True)
class Comparison:
    """What the digests said, and the rows that differ.

    ``levels`` counts, from the root down, the ranges that differ. ``differences`` has the
    columns of the tables, ``side`` (where the row is too often) and ``times``.
    """

    equal: bool
    ranges: Ranges
    differing: tuple[int, ...]
    levels: tuple[int, ...]
    differences: DataFrame


def row_digests(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two digests of a row; nulls count by their place."""
    values = [F.col(f"`{c}`") for c in columns]
    absent = [v.isNull() for v in values]
    return F.xxhash64(*values, *absent), F.xxhash64(F.lit("again"), *reversed(values), *absent)


def key_ranges(df: DataFrame, column: str, leaves: int = FAN_OUT**LEVELS) -> Ranges:
    """About equal ranges of a numeric, date or timestamp column, by approximate quantiles."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"ranges need a number, date or timestamp, and {column} is {kind.simpleString()}")
    shares = [i / leaves for i in range(1, leaves)]
    row = df.agg(F.percentile_approx(f"`{column}`", shares, 10_000).alias("bounds")).first()
    return Ranges(column, tuple(sorted(set(row.bounds or ()))))


def range_digests(df: DataFrame, ranges: Ranges, columns: Sequence[str]) -> DataFrame:
    """(leaf, n, first, second) of every range that has rows: one row per task is shuffled."""
    first, second = row_digests(columns)
    return (
        df.select(ranges.number().alias("leaf"), first.alias("first"), second.alias("second"))
        .groupBy("leaf")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("first").cast(_SUM)).alias("first"),
            F.sum(F.col("second").cast(_SUM)).alias("second"),
        )
    )


def compare_tables(left: DataFrame, right: DataFrame, key: str, leaves: int = FAN_OUT**LEVELS) -> Comparison:
    """Compare two tables of the same columns, in any order, as multisets of rows.

    ``key`` is the column whose ranges are told apart. Types must agree. Nulls are equal to
    each other.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    right = right.select(left.columns)
    other = [f.name for f, g in zip(left.schema, right.schema) if f.dataType != g.dataType]
    if other:
        raise ValueError(f"types of {other} differ")
    ranges = key_ranges(left, key, leaves)
    told: list[dict[int, tuple]] = [
        {r.leaf: (r.n, r.first, r.second) for r in range_digests(df, ranges, left.columns).collect()}
        for df in (left, right)
    ]
    differing = sorted(k for k in told[0].keys() | told[1].keys() if told[0].get(k) != told[1].get(k))
    levels, numbers = [len(differing)], differing
    for _ in range(LEVELS):
        # The nulls' leaf hangs on the first branch.
        numbers = sorted({max(n, 0) // FAN_OUT for n in numbers})
        levels.insert(0, len(numbers))
    return Comparison(
        not differing, ranges, tuple(differing), tuple(levels), _differences(left, right, ranges, differing)
    )


def _differences(left: DataFrame, right: DataFrame, ranges: Ranges, differing: Sequence[int]) -> DataFrame:
    """Rows that one side has more often than the other, within some ranges."""
    wanted = ranges.rows_of(differing)
    both = left.where(wanted).withColumn("_sign", F.lit(1)).unionByName(
        right.where(wanted).withColumn("_sign", F.lit(-1))
    )
    counted = both.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.sum("_sign").alias("_sign"))
    side = F.when(F.col("_sign") > 0, F.lit(ONLY_LEFT)).otherwise(F.lit(ONLY_RIGHT))
    return counted.where("_sign <> 0").select(
        *[F.col(f"`{c}`") for c in left.columns], side.alias("side"), F.abs("_sign").cast("long").alias("times")
    )
