"""Feed extract: satellite versions reduced to one per key, then joined to the hub."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.functions.unit_codes import FEED_LAYOUT, UnitLayout, decode_unit
from stammwerk.operators.versions import AS_WRITTEN, pick_version, version_order
from stammwerk.plans.feeds import INITIAL, FeedSpec, check_load_type
from stammwerk.session import stored
from stammwerk.sources.tables import read_source

BROADCAST = "broadcast"


def changed_after(df: DataFrame, column: str, bound: date | datetime | str) -> Column:
    """``column > bound``, the bound typed like the column so that the scan can use it."""
    return F.col(column) > F.lit(str(bound)).cast(df.schema[column].dataType)


def equals(df: DataFrame, column: str, value: object) -> Column:
    """``column = value``, the value typed like the column."""
    return F.col(column) == F.lit(value).cast(df.schema[column].dataType)


def extract(
    feed: FeedSpec,
    hub: DataFrame,
    satellite: DataFrame,
    load_type: str = INITIAL,
    changed_since: date | datetime | str | None = None,
    order: str = AS_WRITTEN,
    layout: UnitLayout = FEED_LAYOUT,
    strict_codes: bool = True,
    hub_join: str | None = None,
) -> DataFrame:
    """One row per hub hash key.

    All filters and ranking columns belong to the satellite, so it is ranked before
    the join: that leaves at most one row per key to join, and a hash key with many
    versions never reaches the join. Both sides of the join are then already
    partitioned and sorted by the key.

    Spark chooses the join by its own size statistics. ``hub_join="broadcast"`` stores the
    ranked rows first, so that Spark knows their size: below its threshold for broadcasts
    the hub is only scanned, above it both sides are shuffled as without the option. To
    spare a large hub the shuffle in any case, bucket hub and satellite by the hash key.
    """
    check_load_type(load_type)
    if hub_join not in (None, BROADCAST):
        raise ValueError(f"hub_join must be None or {BROADCAST!r}, not {hub_join!r}")
    rows = satellite
    if load_type == INITIAL:
        rows = rows.where(F.col(feed.loaded_at).isNotNull())
    elif changed_since is None:
        raise ValueError("a delta load needs changed_since")
    else:
        rows = rows.where(changed_after(satellite, feed.change_date, changed_since))
    for column, value in feed.equals.items():
        rows = rows.where(equals(satellite, column, value))

    payload = [*feed.satellite_columns, *feed.version_columns, feed.tie_break]
    picked = pick_version(
        rows.select(feed.key, *payload),
        [feed.key],
        [*version_order(feed.version_columns, order), F.asc(feed.tie_break)],
    )
    keys = hub.select(feed.key, *feed.hub_columns)
    hub_order = [F.asc(c) for c in feed.hub_columns]
    if hub_join == BROADCAST:
        joined = keys.join(stored(picked, "changed"), feed.key)
        if not feed.hub_is_unique:
            joined = pick_version(joined, [feed.key], hub_order)
    else:
        if not feed.hub_is_unique:
            keys = pick_version(keys, [feed.key], hub_order)
        joined = picked.join(keys, feed.key)

    return joined.select(feed_columns(feed, layout, strict_codes))


def feed_columns(
    feed: FeedSpec, layout: UnitLayout = FEED_LAYOUT, strict_codes: bool = True
) -> list[Column]:
    """What an extract shows of a hub row joined to a satellite version."""
    parts = []
    if feed.unit_code:
        decoded = decode_unit(F.col(feed.unit_code), layout, strict_codes)
        parts = [decoded[part].alias(name) for part, name in feed.unit_names.items()]
    plain = [*feed.hub_columns, *feed.satellite_columns]
    return [*map(F.col, plain), *parts, *map(F.col, [*feed.version_columns, feed.tie_break])]


def extract_feed(
    spark: SparkSession,
    feed: FeedSpec,
    source_schema: str | None = None,
    **options,
) -> DataFrame:
    """:func:`extract` over the feed's own tables or views, found in ``source_schema``."""
    prefix = f"{source_schema}." if source_schema else ""
    return extract(
        feed,
        read_source(spark, table=prefix + feed.hub),
        read_source(spark, table=prefix + feed.satellite),
        **options,
    )
