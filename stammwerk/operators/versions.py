"""One version per key.

Ranking with ``row_number() = 1`` lets Spark keep one row per key already in each
map task (WindowGroupLimit before the shuffle), so a key that holds a large part
of the table sends one row per task and never fills a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_DATE = "TSAEND"
AS_WRITTEN = "as_written"
LATEST = "latest"

_RANK = "_version_rank"


def pick_version(
    versions: DataFrame, keys: Sequence[str], order: Sequence[Column], gather_by: Sequence[str] = ()
) -> DataFrame:
    """The first row of each key in the given order.

    ``gather_by`` names some of the keys: rows are then shuffled by these alone, and not at all
    where they are so already, and the result stays gathered by them. Versions are not reduced
    before the shuffle, so no value of these columns should own a large part of the rows.
    """
    if gather_by:
        rest = [k for k in keys if k not in gather_by]
        window = Window.partitionBy(*gather_by).orderBy(*map(F.asc, rest), *order)
        first = F.row_number().over(window) == 1
        for k in rest:
            first = first | ~F.col(k).eqNullSafe(F.lag(k).over(window))
        return versions.withColumn(_RANK, first).where(F.col(_RANK)).drop(_RANK)
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = versions.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def current_rows(
    versions: DataFrame,
    keys: Sequence[str],
    tie_break: Sequence[str] | None = None,
    changed: str = CHANGE_DATE,
    gather_by: Sequence[str] = (),
) -> DataFrame:
    """The newest row of each key.

    ``tie_break`` decides, descending, between rows of one key that changed at the
    same time. Without it all other columns do, so that a task that is run again
    picks the same row. State the columns where a few are enough; ``()`` says that
    such rows do not occur. ``gather_by`` is that of :func:`pick_version`.
    """
    if tie_break is None:
        tie_break = [c for c in versions.columns if c not in (*keys, changed)]
    return pick_version(versions, keys, [F.desc(changed), *map(F.desc, tie_break)], gather_by)


def gather_columns(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """``gather_by`` for rows that are stored by ``columns``: none where these are all keys.

    Rows picked so are gathered by ``columns`` either way.
    """
    return list(columns) if set(columns) < set(keys) else []


def version_order(columns: Sequence[str], order: str) -> list[Column]:
    """Sort columns of a feed's ranking.

    ``as_written`` is ascending but for the last column, so it keeps the *oldest*
    change date; ``latest`` is descending throughout.
    """
    if order == AS_WRITTEN:
        *leading, last = columns
        return [*map(F.asc, leading), F.desc(last)]
    if order == LATEST:
        return [F.desc(c) for c in columns]
    raise ValueError(f"order must be {AS_WRITTEN!r} or {LATEST!r}, not {order!r}")
