"""Validity intervals from versions: collapsed histories, aligned entities, as-of joins.

A key's versions are sorted by change date and each is compared with, or filled from, the one
before it. A key may own a large part of all rows, so its versions are not one task's work:
rows are dealt out by ranges of (key, time), and a key may stretch over many ranges. What a
range must know of its neighbours is one row each, such as the last state of its first key.
Such rows are put at the head or the tail of the range, and a plain window per (range, key)
then gives what a window over the whole key would. Only intervals are joined by ranges of
time to versions, beside columns that must be equal.

At most one version per key and time counts; a version without a time is valid from the
beginning. A null key is a key like any other. Intervals are half open: ``valid_from`` is in,
``valid_to`` (null: until further notice) is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stammwerk.operators.versions import CHANGE_DATE, pick_version
from stammwerk.session import stored

VALID_FROM = "valid_from"
VALID_TO = "valid_to"

_PART = "_part"  # number of the range a row was dealt to
_PLACE = "_place"  # head rows come first, tail rows last
_HEAD, _ROW, _TAIL = -1, 0, 1


def one_per_time(
    versions: DataFrame, keys: Sequence[str], tie_break: Sequence[str] | None = None, changed: str = CHANGE_DATE
) -> DataFrame:
    """One version per key and time; ties are broken as by ``current_rows``."""
    if tie_break is None:
        tie_break = [c for c in versions.columns if c not in (*keys, changed)]
    return pick_version(versions, [*keys, changed], [F.desc(c) for c in tie_break] or [F.lit(0)])


def _dealt(rows: DataFrame, order: Sequence[str], parts: int | None) -> DataFrame:
    """Rows with the number of the range of ``order`` they are in."""
    count = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, *[F.col(c) for c in order])
    return stored(ranged.withColumn(_PART, F.spark_partition_id()).withColumn(_PLACE, F.lit(_ROW)), "ranges")


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys)


def _edges(dealt: DataFrame, keys: Sequence[str], order: Sequence[str], *more: Column) -> DataFrame:
    """One row per range that has rows: its first and last key and what ``more`` adds up."""
    at = F.struct(*order)
    return dealt.groupBy(_PART).agg(
        F.min_by(_key(keys), at).alias("first_key"),
        F.max_by(_key(keys), at).alias("last_key"),
        F.min(at).alias("first_at"),
        *more,
    )


def _by_range() -> Window:
    return Window.orderBy(_PART)  # over one row per range


def _tails(edges: DataFrame, at: str) -> DataFrame:
    """Where a range's last key goes on in the next one: that one's first time as a tail row."""
    following = edges.select(
        _PART,
        "last_key",
        F.lead("first_key").over(_by_range()).alias("key_after"),
        F.lead("first_at").over(_by_range())[at].alias(at),
    )
    return following.where(F.col(at).isNotNull() & F.col("last_key").eqNullSafe(F.col("key_after"))).select(
        _PART, F.lit(_TAIL).alias(_PLACE), "last_key.*", at
    )


def _window(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(_PART, *keys).orderBy(_PLACE, *order)


def _with(rows: DataFrame, others: DataFrame) -> DataFrame:
    return rows.unionByName(others, allowMissingColumns=True)


# --- collapsed histories -------------------------------------------------------


def collapse_history(
    versions: DataFrame,
    keys: Sequence[str],
    attributes: Sequence[str],
    tie_break: Sequence[str] | None = None,
    changed: str = CHANGE_DATE,
    parts: int | None = None,
) -> DataFrame:
    """Consecutive versions of equal ``attributes`` as one interval.

    Returns the columns of the interval's first version (without ``changed``), ``valid_from``
    and ``valid_to``. Nulls among the attributes are equal to each other. Rows are dealt out
    by ``parts`` ranges of key and time (as many as shuffle partitions by default); the
    result does not depend on it.
    """
    order = [*keys, changed]
    dealt = _dealt(one_per_time(versions, keys, tie_break, changed), order, parts)
    state = F.struct(*attributes)
    edges = stored(_edges(dealt, keys, order, F.max_by(state, F.struct(*order)).alias("last_state")), "edges")

    # The last state before each range, where its first key began in an earlier one.
    before = edges.select(
        _PART,
        "first_key",
        F.lag("last_key").over(_by_range()).alias("key_before"),
        F.lag("last_state").over(_by_range()).alias("state_before"),
    )
    # A range without an earlier one has no state to compare with, rather than a state of nulls.
    heads = before.where(F.col("state_before").isNotNull() & F.col("first_key").eqNullSafe(F.col("key_before"))).select(
        _PART, F.lit(_HEAD).alias(_PLACE), "first_key.*", "state_before.*"
    )
    window = _window(keys, [changed])
    begins = ~F.col("_state").eqNullSafe(F.lag("_state").over(window)) | (F.row_number().over(window) == 1)
    starts = stored(
        _with(dealt, heads).withColumn("_state", state)
        .withColumn("_begins", begins)
        .where(F.col("_begins") & (F.col(_PLACE) == _ROW))
        .drop("_state", "_begins"),
        "starts",
    )

    # Where the last interval of each range ends, if its key goes on in later ranges: at that
    # key's first start there.
    first_start = starts.groupBy(_PART).agg(F.min(F.struct(_key(keys).alias("key"), F.col(changed).alias("at"))).alias("start"))
    known = edges.join(first_start, _PART, "left").select(
        _PART,
        "first_key",
        "last_key",
        F.when(F.col("start.key").eqNullSafe(F.col("first_key")), F.col("start.at")).alias("at"),
    )
    onwards = Window.partitionBy("first_key").orderBy(_PART).rowsBetween(0, Window.unboundedFollowing)
    ahead = known.withColumn("at", F.first("at", ignorenulls=True).over(onwards)).select(
        _PART,
        "last_key",
        F.lead("first_key").over(_by_range()).alias("key_after"),
        F.lead("at").over(_by_range()).alias("at"),
    )
    tails = ahead.where(F.col("at").isNotNull() & F.col("last_key").eqNullSafe(F.col("key_after"))).select(
        _PART, F.lit(_TAIL).alias(_PLACE), "last_key.*", F.col("at").alias(changed)
    )
    kept = [c for c in versions.columns if c != changed]
    return (
        _with(starts, tails)
        .withColumn(VALID_TO, F.lead(changed).over(window))
        .where(F.col(_PLACE) == _ROW)
        .select(*kept, F.col(changed).alias(VALID_FROM), VALID_TO)
    )


# --- aligned entities ----------------------------------------------------------


def _carried(dealt: DataFrame, keys: Sequence[str], order: Sequence[str], states: Sequence[str]) -> DataFrame:
    """(range, key, states): the last state of each kind that earlier ranges hold for a
    range's first key."""
    at = F.struct(*order)
    lasts = [
        F.max(F.when(F.col(s).isNotNull(), F.struct(_key(keys).alias("key"), at.alias("at"), F.col(s).alias("state"))))
        .alias(s)
        for s in states
    ]
    edges = stored(_edges(dealt, keys, order, *lasts), "edges")
    found = edges.select(_PART, F.col("first_key").alias("key"), F.lit(0).alias("_answer"))
    for s in states:
        told = edges.where(f"`{s}` IS NOT NULL").select(
            _PART, F.col(f"`{s}`.key").alias("key"), F.lit(1).alias("_answer"), F.col(f"`{s}`.state").alias(s)
        )
        found = found.unionByName(told, allowMissingColumns=True)
    # A range asks before it tells, so it hears of earlier ranges only.
    past = Window.partitionBy("key").orderBy(_PART, "_answer").rowsBetween(Window.unboundedPreceding, 0)
    heard = found.withColumns({s: F.last(s, ignorenulls=True).over(past) for s in states})
    some = " OR ".join(f"`{s}` IS NOT NULL" for s in states)
    return heard.where(f"_answer = 0 AND ({some})").select(_PART, F.lit(_HEAD).alias(_PLACE), "key.*", *states)


def timeline(
    entities: Mapping[str, DataFrame],
    keys: Sequence[str],
    tie_breaks: Mapping[str, Sequence[str]] | None = None,
    changed: str = CHANGE_DATE,
    parts: int | None = None,
) -> DataFrame:
    """The versions of several entities of one key, aligned: a row per distinct interval.

    ``entities`` are versions by name, all with ``keys`` and ``changed``. The result has the keys,
    ``valid_from``, ``valid_to``, and per entity a struct, named like it, of its other
    columns and its change date: the version that is valid, or null before the first. Rows of
    all entities are merged in order of time and each entity's last version is carried
    on; versions are never multiplied. The first entity leads: intervals before its first
    version are left out, as by a left join from it.
    """
    names = list(entities)
    lead = names[0]
    merged = None
    for name, versions in entities.items():
        picked = one_per_time(versions, keys, (tie_breaks or {}).get(name), changed)
        payload = F.struct(*[c for c in versions.columns if c not in keys])
        rows = picked.select(*keys, F.col(changed).alias(VALID_FROM), payload.alias(name))
        merged = rows if merged is None else merged.unionByName(rows, allowMissingColumns=True)
    events = merged.groupBy(*keys, VALID_FROM).agg(*[F.first(n, ignorenulls=True).alias(n) for n in names])
    return _aligned(events, keys, names, parts).where(F.col(lead).isNotNull())


def _aligned(events: DataFrame, keys: Sequence[str], names: Sequence[str], parts: int | None) -> DataFrame:
    """Events, one per key and ``valid_from``, with each state carried on to the next one."""
    order = [*keys, VALID_FROM]
    dealt = _dealt(events, order, parts)
    heads = _carried(dealt, keys, order, names)
    tails = _tails(_edges(dealt, keys, order), VALID_FROM)
    window = _window(keys, [VALID_FROM])
    past = window.rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with(_with(dealt, heads), tails)
        .withColumns(
            {VALID_TO: F.lead(VALID_FROM).over(window)}
            | {n: F.last(n, ignorenulls=True).over(past) for n in names}
        )
        .where(F.col(_PLACE) == _ROW)
        .select(*keys, VALID_FROM, VALID_TO, *names)
    )


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    name: str,
    tie_break: Sequence[str] | None = None,
    changed: str = CHANGE_DATE,
    parts: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the version of ``right`` that was valid at its time ``at``.

    The version is a struct called ``name`` of ``right``'s columns without the keys; null where
    there is none yet. A version is valid from its own time on. A null time in ``left`` sees
    only versions that are valid from the beginning.
    """
    picked = one_per_time(right, keys, tie_break, changed)
    payload = F.struct(*[c for c in right.columns if c not in keys])
    told = picked.select(*keys, F.col(changed).alias("_at"), F.lit(0).alias("_asks"), payload.alias(name))
    asked = left.select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_asks"), F.struct(*left.columns).alias("_left")
    )
    order = [*keys, "_at", "_asks"]
    dealt = _dealt(told.unionByName(asked, allowMissingColumns=True), order, parts)
    heads = _carried(dealt, keys, order, [name])
    past = _window(keys, ["_at", "_asks"]).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with(dealt, heads)
        .withColumn(name, F.last(name, ignorenulls=True).over(past))
        .where("_asks = 1")
        .select("_left.*", name)
    )


# --- intervals joined to versions ----------------------------------------------


def _running_count(changes: DataFrame, keys: Sequence[str], parts: int | None) -> DataFrame:
    """(keys, valid_from, valid_to, count) from each change to the next; ``change`` is summed up."""
    order = [*keys, VALID_FROM]
    dealt = _dealt(changes.groupBy(*order).agg(F.sum("change").alias("change")), order, parts)
    edges = stored(_edges(dealt, keys, order), "edges")
    by_key = dealt.groupBy(_PART, _key(keys).alias("key")).agg(F.sum("change").alias("change"))
    ends = by_key.join(edges, _PART).where(F.col("key").eqNullSafe(F.col("last_key"))).select(
        _PART, "key", "change", F.lit(1).alias("_answer")
    )
    asks = edges.select(_PART, F.col("first_key").alias("key"), F.lit(0).cast("long").alias("change"), F.lit(0).alias("_answer"))
    past = Window.partitionBy("key").orderBy(_PART, "_answer").rowsBetween(Window.unboundedPreceding, 0)
    heads = (
        asks.unionByName(ends).withColumn("change", F.sum("change").over(past)).where("_answer = 0")
        .select(_PART, F.lit(_HEAD).alias(_PLACE), "key.*", "change")
    )
    window = _window(keys, [VALID_FROM])
    return (
        _with(_with(dealt, heads), _tails(edges, VALID_FROM))
        .withColumn("count", F.sum("change").over(window.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(VALID_TO, F.lead(VALID_FROM).over(window))
        .where(F.col(_PLACE) == _ROW).select(*order, VALID_TO, "count")
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def _states(intervals: DataFrame, keys: Sequence[str], payload: Column, active: Column) -> DataFrame:
    """Events (keys, valid_from, _left) where intervals begin and, unless another begins there, end."""
    begins = intervals.select(*keys, VALID_FROM, F.struct(active.alias("active"), payload.alias("row")).alias("_left"))
    nothing = F.lit(None).cast(begins.schema["_left"].dataType["row"].dataType)
    ends = intervals.where(F.col(VALID_TO).isNotNull()).select(
        *keys, F.col(VALID_TO).alias(VALID_FROM), F.struct(F.lit(False).alias("active"), nothing.alias("row")).alias("_left")
    )
    # A row that begins stands above the end of the one before it, active or not.
    told = begins.withColumn("_rank", F.lit(1)).unionByName(ends.withColumn("_rank", F.lit(0)))
    return told.groupBy(*keys, VALID_FROM).agg(F.max_by("_left", "_rank").alias("_left"))


def interval_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    name: str,
    tie_break: Sequence[str] | None = None,
    changed: str = CHANGE_DATE,
    parts: int | None = None,
) -> DataFrame:
    """Intervals with the versions of ``right`` that are valid meanwhile.

    ``left`` has ``valid_from`` and ``valid_to``; intervals of equal ``left_keys`` do not
    overlap (as :func:`timeline` and this join leave them). A version of ``right`` is valid
    until the next one of its ``right_keys``. For every interval and every key whose valid
    version agrees on all (left, right) column pairs of ``on``, the result has a row per
    stretch of time in which nothing changes, with ``name`` a struct of that version's
    columns; stretches without any such version have one row with a null. Null columns
    agree with nothing.

    Beside ``right``'s intervals stand the gaps in which no version has a value, so one equi-join by
    overlap finds every stretch, matched or not. It compares all intervals and versions of a pair
    of keys; left keys of more than ``MANY`` intervals are merged with the versions in order of time
    instead, where a key of ``right`` has that many versions too.
    """
    met = [f"_on{i}" for i in range(len(on))]
    told = _told(right, met, on, right_keys, name, tie_break, changed, parts)
    keys = F.struct(*[F.col(name)[k] for k in right_keys])
    if told.groupBy(*met, keys.alias("_key")).count().where(F.col("count") > MANY).isEmpty():
        return _overlapping(left, told, met, on, name)
    left = stored(left, "left")
    theirs = [f"_l{i}" for i in range(len(left_keys))]
    long = left.groupBy(*[F.col(k).alias(t) for k, t in zip(left_keys, theirs)]).count().where(F.col("count") > MANY)
    long = stored(long.drop("count"), "long")
    if long.isEmpty():
        return _overlapping(left, told, met, on, name)
    short = _overlapping(left.join(long, _same(left_keys, theirs), "left_anti"), told, met, on, name)
    return short.union(
        _merged(
            left.join(long, _same(left_keys, theirs), "left_semi"),
            right, on, left_keys, right_keys, name, tie_break, changed, parts,
        )
    )


# So many intervals of one left key and versions of one right key are not compared one by one.
MANY = 200


def _told(
    right: DataFrame,
    met: Sequence[str],
    on: Sequence[tuple[str, str]],
    keys: Sequence[str],
    name: str,
    tie_break: Sequence[str] | None,
    changed: str,
    parts: int | None,
) -> DataFrame:
    """(met, valid_from, valid_to, name): ``right``'s intervals and, with a null, the times when a
    value of ``met`` has none. For each value they cover all time."""
    order = [*keys, changed]
    dealt = _dealt(one_per_time(right, keys, tie_break, changed), order, parts)
    ended = (
        _with(dealt, _tails(_edges(dealt, keys, order), changed))
        .withColumn(VALID_TO, F.lead(changed).over(_window(keys, [changed])))
        .where(F.col(_PLACE) == _ROW)
    )
    versions = stored(
        ended.select(
            *[F.col(b).alias(m) for (_, b), m in zip(on, met)],
            F.col(changed).alias(VALID_FROM), VALID_TO, F.struct(*right.columns).alias(name),
        ).dropna(subset=met),
        "versions",
    )
    steps = versions.select(*met, VALID_FROM, F.lit(1).alias("change")).union(
        versions.where(F.col(VALID_TO).isNotNull()).select(*met, VALID_TO, F.lit(-1))
    )
    counts = _running_count(steps, met, parts)
    before = (
        versions.groupBy(*met)
        .agg(F.min(VALID_FROM).alias(VALID_TO), F.bool_or(F.col(VALID_FROM).isNull()).alias("_ever"))
        .where("NOT _ever")
        .select(*met, F.lit(None).cast(versions.schema[VALID_FROM].dataType).alias(VALID_FROM), VALID_TO)
    )
    gaps = stored(counts.where("count = 0").select(*met, VALID_FROM, VALID_TO).union(before), "gaps")
    return versions.unionByName(gaps, allowMissingColumns=True)


def _overlapping(
    left: DataFrame, told: DataFrame, met: Sequence[str], on: Sequence[tuple[str, str]], name: str
) -> DataFrame:
    """Each interval with each of ``told`` it overlaps; a null where its values are not told of."""
    def starts_before(start: str, end: str) -> Column:
        return F.col(start).isNull() | F.col(end).isNull() | (F.col(start) < F.col(end))

    condition = starts_before(VALID_FROM, "_to") & starts_before("_from", VALID_TO)
    for (a, _), m in zip(on, met):
        condition = condition & (F.col(a) == F.col(m))
    # A null is the beginning or the end of time; both functions pass over it.
    ends = {VALID_FROM: F.greatest(VALID_FROM, "_from"), VALID_TO: F.least(VALID_TO, "_to")}
    joined = left.join(told.withColumnsRenamed({VALID_FROM: "_from", VALID_TO: "_to"}), condition, "left")
    return joined.select(*[ends[c].alias(c) if c in ends else F.col(c) for c in left.columns], name)


def _merged(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    name: str,
    tie_break: Sequence[str] | None,
    changed: str,
    parts: int | None,
) -> DataFrame:
    """:func:`interval_left_join` by merging in order of time.

    Which keys meet which follows from an equi-join of the different values; a pair's intervals
    and versions are then merged in order of time, so they add up and are not multiplied.
    """
    met = [f"_on{i}" for i in range(len(on))]
    theirs = [f"_r{i}" for i in range(len(right_keys))]
    picked = one_per_time(right, right_keys, tie_break, changed)
    pairs = stored(
        left.select(*left_keys, *[F.col(a).alias(m) for (a, _), m in zip(on, met)]).dropna(subset=met).distinct()
        .join(
            picked.select(
                *[F.col(k).alias(t) for k, t in zip(right_keys, theirs)], *[F.col(b).alias(m) for (_, b), m in zip(on, met)]
            ).dropna(subset=met).distinct(),
            met,
        ),
        "pairs",
    )
    pair_keys = [*left_keys, *theirs, *met]
    others = [c for c in left.columns if c not in (*left_keys, VALID_FROM, VALID_TO)]
    row = F.struct(*others) if others else F.struct(F.lit(None).alias("_none"))

    mine = [f"_l{i}" for i in range(len(left_keys))]
    renamed = pairs.withColumnsRenamed(dict(zip(left_keys, mine)))
    paired = left.join(renamed, _same(left_keys, mine)).drop(*mine)
    from_left = _states(paired, pair_keys, row, _same([a for a, _ in on], met))
    version = picked.select(
        F.struct(*right.columns).alias("_version"), F.col(changed).alias(VALID_FROM),
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(right_keys)], *[F.col(b).alias(f"_b{i}") for i, (_, b) in enumerate(on)],
    )
    from_right = version.join(pairs, _same([f"_k{i}" for i in range(len(right_keys))], theirs)).select(
        *pair_keys, VALID_FROM,
        F.struct(_same([f"_b{i}" for i in range(len(on))], met).alias("active"), F.col("_version").alias("row")).alias("_right"),
    )
    events = from_left.unionByName(from_right, allowMissingColumns=True).groupBy(*pair_keys, VALID_FROM).agg(
        F.first("_left", ignorenulls=True).alias("_left"), F.first("_right", ignorenulls=True).alias("_right")
    )
    both = stored(
        _aligned(events, pair_keys, ["_left", "_right"], parts).where("_left.active AND _right.active")
        .select(*left_keys, VALID_FROM, VALID_TO, "_left.row", F.col("_right.row").alias(name)),
        "matched",
    )

    # How many rows are matched at a time, and where that is none.
    steps = both.select(*left_keys, VALID_FROM, F.lit(1).alias("change")).union(
        both.where(F.col(VALID_TO).isNotNull()).select(*left_keys, VALID_TO, F.lit(-1))
    )
    counts = _running_count(steps, left_keys, parts).drop(VALID_TO).withColumnRenamed("count", "_count")
    spans = _states(left, left_keys, row, F.lit(True))
    events = spans.unionByName(counts, allowMissingColumns=True).groupBy(*left_keys, VALID_FROM).agg(
        F.first("_left", ignorenulls=True).alias("_left"), F.first("_count", ignorenulls=True).alias("_count")
    )
    alone = (
        _aligned(events, left_keys, ["_left", "_count"], parts)
        .where("_left.active AND coalesce(_count, 0) = 0")
        .select(*left_keys, VALID_FROM, VALID_TO, "_left.row", F.lit(None).cast(both.schema[name].dataType).alias(name))
    )
    shown = [F.col(f"row.{c}").alias(c) if c in others else F.col(c) for c in left.columns]
    return both.union(alone).select(*shown, name)
