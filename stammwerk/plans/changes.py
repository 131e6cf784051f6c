"""Deltas that miss no late version and repeat no unchanged one.

A delta by change date alone misses a version that arrives late with an old date, and loads
again what it has loaded before. Here a feed remembers what it has met:

- ``<feed>_seen``: hash key and digest of every version, a partition per run;
- ``<feed>``: a view of the extract so far, one row per hash key, refreshed by bucket
  (:mod:`stammwerk.plans.current_store`). With it are published the number of the last
  complete run and the high-water mark, the newest change date met;
- ``<feed>_delta``: what each run delivers, a partition per run.

Versions above the mark are new. Of the others those are new whose key and digest have not
been seen, found by an anti join that is spread by both columns. A version whose hub row is
missing counts as not met, so it is found once the hub row is there. A key is delivered when
another version wins its ranking and that version's ``MD_HDIFF_ATTRIBUTES`` differ from the
ones delivered last.

The view is replaced last and in one operation: a run that dies before it is taken up again from
the start and overwrites its own partitions. One run of a feed at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stammwerk.functions.unit_codes import FEED_LAYOUT, UnitLayout
from stammwerk.operators.extract import equals, feed_columns
from stammwerk.operators.versions import LATEST, pick_version, version_order
from stammwerk.plans.current_store import build_current, published_properties, refresh_current
from stammwerk.plans.feeds import DELTA, FeedSpec
from stammwerk.session import remove, stored_at
from stammwerk.sinks.writers import write_table

RUN = "_run"
_DIGEST = "_digest"
_LAST_RUN = "stammwerk.run"
_MARK = "stammwerk.mark"


@dataclass(frozen=True)
class FeedStore:
    """Names of what is remembered of one feed."""

    schema: str
    feed: str

    @property
    def picked(self) -> str:
        return f"{self.schema}.{self.feed.lower()}"

    @property
    def seen(self) -> str:
        return f"{self.picked}_seen"

    @property
    def delta(self) -> str:
        return f"{self.picked}_delta"


def version_digest(feed: FeedSpec) -> Column:
    """Tells versions of one key apart; nulls count by their place."""
    columns = [*feed.satellite_columns, *feed.version_columns, feed.tie_break]
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def last_run(spark: SparkSession, store: FeedStore) -> tuple[int, str | None]:
    """Number of the last complete run (0: none) and the mark it left."""
    if not spark.catalog.tableExists(store.picked):
        return 0, None
    said = published_properties(spark, store.picked)
    return int(said[_LAST_RUN]), said.get(_MARK)


def _versions(feed: FeedSpec, satellite: DataFrame) -> DataFrame:
    rows = satellite.where(F.col(feed.loaded_at).isNotNull() & F.col(feed.key).isNotNull())
    for column, value in feed.equals.items():
        rows = rows.where(equals(satellite, column, value))
    needed = [feed.key, *feed.satellite_columns, *feed.version_columns, feed.tie_break]
    return rows.select(*dict.fromkeys(needed)).withColumn(_DIGEST, version_digest(feed))


def new_versions(feed: FeedSpec, satellite: DataFrame, store: FeedStore) -> DataFrame:
    """The satellite's versions that no complete run has met."""
    spark = satellite.sparkSession
    run, mark = last_run(spark, store)
    rows = _versions(feed, satellite)
    if not run:
        return rows
    seen = spark.table(store.seen).where(F.col(RUN) <= run).select(feed.key, _DIGEST)
    if mark is None:
        return rows.join(seen, [feed.key, _DIGEST], "left_anti").select(rows.columns)
    date = F.col(feed.change_date)
    bound = F.lit(mark).cast(rows.schema[feed.change_date].dataType)
    late = rows.where((date <= bound) | date.isNull()).join(seen, [feed.key, _DIGEST], "left_anti")
    return rows.where(date > bound).unionByName(late.select(rows.columns))


def _in_run(rows: DataFrame, table: str, run: int) -> None:
    """Write the partition of a run, replacing what a dead run has left there."""
    numbered = rows.withColumn(RUN, F.lit(run))
    if rows.sparkSession.catalog.tableExists(table):
        write_table(numbered, table, DELTA, replace_partition={RUN: run})
    else:
        write_table(numbered, table, DELTA, [RUN], gather=False)


def take_changes(
    feed: FeedSpec,
    hub: DataFrame,
    satellite: DataFrame,
    schema: str,
    order: str = LATEST,
    buckets: int | None = None,
) -> int:
    """Take in what is new in the satellite; returns the run's number.

    The first run takes everything. Afterwards the view shows what a full extract by the
    same ``order`` would, and the delta table what changed.
    """
    spark = satellite.sparkSession
    store = FeedStore(schema, feed.name)
    run, mark = last_run(spark, store)
    run += 1
    keys = pick_version(hub.select(feed.key, *feed.hub_columns), [feed.key], [F.asc(c) for c in feed.hub_columns])
    found = new_versions(feed, satellite, store).join(keys, feed.key)
    path, met = stored_at(found, "new-versions")
    _in_run(met.select(feed.key, _DIGEST).distinct(), store.seen, run)

    ranking = [*version_order(feed.version_columns, order), F.asc(feed.tie_break)]
    newest = pick_version(met.drop(_DIGEST), [feed.key], ranking)
    highest = met.agg(F.max(feed.change_date).cast("string")).first()[0]
    kind = satellite.schema[feed.change_date].dataType
    said = {_LAST_RUN: str(run)}
    if mark or highest:
        # Compared as what they are, not as texts.
        known = spark.range(1).select(F.greatest(F.lit(mark).cast(kind), F.lit(highest).cast(kind)).cast("string"))
        said[_MARK] = known.first()[0]
    if run == 1:
        _in_run(newest, store.delta, run)
        build_current(newest, store.picked, [feed.key], buckets, properties=said, gathered=True)
    else:
        _in_run(_changed(feed, spark.table(store.picked), newest, ranking), store.delta, run)
        refresh_current(
            newest, store.picked, [feed.key], [feed.key], pick=pick_version, properties=said, gathered=True,
            order=ranking,
        )
    remove(spark, path)
    return run


def _changed(feed: FeedSpec, before: DataFrame, newest: DataFrame, ranking: list[Column]) -> DataFrame:
    """The new versions that win over the stored one and differ from it."""
    stored_rows = before.join(newest.select(feed.key), feed.key, "left_semi")
    both = stored_rows.withColumn("_new", F.lit(False)).unionByName(newest.withColumn("_new", F.lit(True)))
    window = Window.partitionBy(feed.key)
    told = F.max(F.when(~F.col("_new"), F.struct(F.col(feed.tie_break).alias("diff")))).over(window)
    ranked = both.withColumns(
        {"_rank": F.row_number().over(window.orderBy(*ranking, F.asc("_new"))), "_told": told}
    )
    differs = F.col("_told").isNull() | ~F.col("_told.diff").eqNullSafe(F.col(feed.tie_break))
    return ranked.where((F.col("_rank") == 1) & F.col("_new") & differs).select(newest.columns)


def extracted(
    spark: SparkSession, feed: FeedSpec, schema: str, layout: UnitLayout = FEED_LAYOUT, strict_codes: bool = True
) -> DataFrame:
    """The extract as of the last complete run, with the columns of a full one."""
    return spark.table(FeedStore(schema, feed.name).picked).select(feed_columns(feed, layout, strict_codes))


def delivered(
    spark: SparkSession,
    feed: FeedSpec,
    schema: str,
    after_run: int = 0,
    layout: UnitLayout = FEED_LAYOUT,
    strict_codes: bool = True,
) -> DataFrame:
    """What the complete runs after ``after_run`` deliver, with each row's run."""
    store = FeedStore(schema, feed.name)
    rows = spark.table(store.delta).where(F.col(RUN).between(after_run + 1, last_run(spark, store)[0]))
    return rows.select(*feed_columns(feed, layout, strict_codes), F.col(RUN))
