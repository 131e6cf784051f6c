"""A left join whose hot keys can be split on both sides.

AQE splits a hot key on the preserved (left) side of a left join, but never one on
the other side: all its rows would meet in one task. An inner join can be split on both
sides, and the left rows without a partner follow from a left anti join, whose right side
is one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stammwerk.session import remove, stored_at


def join_condition(on: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col(lc) == F.col(rc) for lc, rc in on]


def gathered_left_join(
    left: DataFrame, right: DataFrame, gathered: tuple[str, str], on: Sequence[tuple[str, str]]
) -> DataFrame:
    """``left`` left-joined to ``right`` where both are gathered by the pair ``gathered`` already.

    Spark takes rows that are gathered by one column for a join by that column alone, so the
    pairs ``on`` are written as bounds and compared within it. The rows are those of a join on
    all pairs; the work grows with the pairs of rows within one value of the column.
    """
    condition = F.col(gathered[0]) == F.col(gathered[1])
    for lc, rc in on:
        condition = condition & (F.col(lc) >= F.col(rc)) & (F.col(lc) <= F.col(rc))
    return left.join(right, condition, "left")


def left_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], protect: bool = False
) -> DataFrame:
    """``left`` left-joined to ``right`` on the (left, right) column pairs.

    ``protect`` is the caller's word that a few keys own a large part of ``right``: the
    join is then written as an inner join and the unmatched left rows. Both sides are
    evaluated twice, so they should be cheap or stored, and must be deterministic. The
    rows are the same either way. Column names of the two sides must differ.
    """
    if not protect:
        return left.join(right, join_condition(on), "left")
    matched = left.join(right, join_condition(on), "inner").select(*left.columns, *right.columns)
    keys = right.select(*[F.col(rc) for _, rc in on]).distinct()
    alone = left.join(keys, join_condition(on), "left_anti").select(
        *left.columns,
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema],
    )
    return matched.unionByName(alone)


# Types whose equal values are the same value (a zero may be signed, texts may be collated).
_EXACT = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


class Steps:
    """Left joins one after the other, stored on the way so that disk holds one step's shuffles.

    A joined row does without the right columns that equal a left column by the join itself; a
    flag tells whether there was a right row. ``shown`` gives them back at the end, so they
    are neither shuffled nor stored.
    """

    def __init__(self) -> None:
        self._left_out: dict[str, tuple[str, str | Column]] = {}
        self._paths: dict[str, str] = {}

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        self._paths[label], kept = stored_at(df, label)
        return kept

    def forget(self, df: DataFrame, *labels: str) -> None:
        """Delete what was stored under ``labels``; ``df`` must not be built on it."""
        for label in labels:
            if label in self._paths:
                remove(df.sparkSession, self._paths.pop(label))

    def left_join(
        self,
        left: DataFrame,
        right: DataFrame,
        on: Sequence[tuple[str, str]],
        flag: str,
        protect: bool = False,
        gathered: tuple[str, str] | None = None,
        known_by: dict[str, Column] | None = None,
        keys: DataFrame | None = None,
    ) -> DataFrame:
        """``left`` left-joined to ``right`` as by :func:`left_join`, or, where the pair ``gathered``
        is given besides ``on``, by :func:`gathered_left_join`.

        Only ``flag`` says whether a row was found. A protected join is an inner join of the left
        rows whose key is among ``right``'s, which are found and stored first; both sides should be
        stored. ``known_by`` gives expressions of other columns for left columns that are dropped later,
        ``keys`` rows with all keys of ``right`` that are cheaper to read.
        """
        pairs = [gathered, *on] if gathered else on
        out = {}
        for lc, rc in pairs:
            kinds = left.schema[lc].dataType, right.schema[rc].dataType
            if kinds[0] == kinds[1] and isinstance(kinds[0], _EXACT):
                out[rc] = (flag, (known_by or {}).get(lc, lc))
        self._left_out |= out
        if gathered:
            joined = gathered_left_join(left, right, gathered, on).withColumn(flag, F.col(pairs[0][1]).isNotNull())
            return joined.drop(*out)
        if not protect:
            return left_join(left, right, on).withColumn(flag, F.col(pairs[0][1]).isNotNull()).drop(*out)
        keys = (right if keys is None else keys).select(*[F.col(rc) for _, rc in on]).distinct()
        told = left_join(left, keys, on).select(*left.columns, F.col(on[0][1]).isNotNull().alias(flag))
        told = self.stored(told, flag)
        found = told.where(F.col(flag)).join(right, join_condition(on)).drop(*out)
        alone = told.where(~F.col(flag)).select(
            *told.columns,
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in out],
        )
        return found.unionByName(alone)

    def shown(self, column: str) -> Column:
        """A column of the joined rows, whether it was left out or not."""
        if column not in self._left_out:
            return F.col(column)
        flag, source = self._left_out[column]
        known = self.shown(source) if isinstance(source, str) else source
        return F.when(F.col(flag), known).alias(column)
