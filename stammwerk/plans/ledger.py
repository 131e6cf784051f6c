"""Feed loads that may be repeated: each book date is in each target once.

A run first extracts and checks every feed and stores its rows outside the targets. Only when
all of them are there does one ledger entry say so; from then on the run will be carried
through, with these rows, by whoever runs it again. Each target then gets its rows by replacing
its partition of the book date (or all of it in an initial load), which leaves the same content
however often it is done, and an entry says which targets have theirs. A run that dies before
the first entry has touched no target and starts anew; one that dies later goes on with the
targets that lack their entry; one that is complete does nothing.

The ledger is a table of a few rows per run. One run of a process and book date at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.functions.load_metadata import BOOK_DATE
from stammwerk.operators.gate import STRICT, Finding, check_frame, describe_target, passes
from stammwerk.plans.feeds import INITIAL
from stammwerk.plans.jobs import LoadStatus, feed_rows
from stammwerk.session import fresh_path, remove
from stammwerk.sinks.writers import bucket_columns, resolve_target, write_table
from stammwerk.sources.feed_config import FeedPlan, expand_feeds, feed_plans, read_feed_config

STAGED, LOADED, DONE = "staged", "loaded", "done"
LEDGER_SCHEMA = (
    "process string, book_date string, load_type string, run string, step string, job string,"
    " target string, path string, at timestamp"
)


@dataclass(frozen=True)
class Entry:
    """A ledger row without its time."""

    process: str
    book_date: str
    load_type: str
    run: str
    step: str
    job: str | None = None
    target: str | None = None
    path: str | None = None


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries; an empty frame where there is no ledger yet."""
    if spark.catalog.tableExists(ledger):
        spark.catalog.refreshTable(ledger)
        return spark.table(ledger)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def _enter(spark: SparkSession, ledger: str, entries: Sequence[Entry]) -> None:
    """Add entries; they are one file, so all of them appear or none."""
    columns = LEDGER_SCHEMA.rsplit(",", 1)[0]
    rows = spark.createDataFrame([tuple(vars(e).values()) for e in entries], columns)
    stamped = rows.withColumn("at", F.current_timestamp()).coalesce(1)
    if spark.catalog.tableExists(ledger):
        stamped.write.insertInto(ledger)
    else:
        stamped.write.saveAsTable(ledger)


def _entries(spark: SparkSession, ledger: str, process: str, book_date: str) -> list[Entry]:
    rows = read_ledger(spark, ledger).where((F.col("process") == process) & (F.col("book_date") == book_date))
    return [Entry(*r) for r in rows.drop("at").collect()]


def _checked(spark: SparkSession, plan: FeedPlan, rows: DataFrame, type_mode: str) -> list[Finding]:
    name = resolve_target(spark, plan.target)
    target = describe_target(spark, name, type_mode)
    stated = bucket_columns(plan.cluster_columns, plan.partition_columns) if plan.cluster_columns else None
    findings = check_frame(rows.schema, target, plan.partition_columns or None, stated, type_mode)
    if target is not None and plan.load_type != INITIAL and list(target.partition_columns) != [BOOK_DATE]:
        findings.append(
            Finding("one_book_date", "", BOOK_DATE, ",".join(target.partition_columns), False)
        )
    return findings


def _publish(spark: SparkSession, entry: Entry, buckets: int | None) -> None:
    rows = spark.read.parquet(entry.path)
    replaced = None if entry.load_type == INITIAL else {BOOK_DATE: entry.book_date}
    write_table(
        rows, entry.target, entry.load_type, buckets=buckets, gather=False, replace_partition=replaced
    )


def run_feeds_once(
    spark: SparkSession,
    config_path: str,
    book_date: date | str,
    load_user: str,
    ledger: str,
    load_type: str | None = None,
    changed_since: date | str | None = None,
    parallel: int = 4,
    type_mode: str = STRICT,
    buckets: int | None = None,
    **options,
) -> list[LoadStatus]:
    """Run every feed of a configuration so that it may be run again.

    All targets are loaded or none: a feed that fails, or does not fit its target, leaves
    every target as it is, and its status says why. A delta replaces the target's partition of
    the book date, so the target must be partitioned by it alone; rows that something else put
    there are replaced too. A book date that was loaded by one load type raises for another.
    """
    plans = feed_plans(expand_feeds(read_feed_config(spark, config_path), load_type, changed_since))
    if not plans:
        return []
    day, kind = str(book_date), plans[0].load_type
    process = "/".join((plans[0].process or "", plans[0].tenant_process or "", plans[0].source_system or ""))
    known = _entries(spark, ledger, process, day)
    others = sorted({e.load_type for e in known} - {kind})
    if others:
        raise ValueError(f"{process} has loaded {day} by {others[0]} and cannot by {kind}")

    staged = [e for e in known if e.step == STAGED]
    if not staged:
        staged, statuses = _stage(
            spark, plans, process, day, load_user, kind, parallel, type_mode, options
        )
        if staged is None:
            return statuses
        _enter(spark, ledger, staged)
    loaded = {e.job for e in known if e.step == LOADED}
    done = any(e.step == DONE for e in known)

    def publish(entry: Entry) -> None:
        _publish(spark, entry, buckets)

    if not done:
        waiting = [e for e in staged if e.job not in loaded]
        with ThreadPoolExecutor(parallel) as pool:
            # Entries are written one by one as targets are ready, never two at a time.
            for entry, _ in zip(waiting, pool.map(publish, waiting)):
                _enter(spark, ledger, [Entry(process, day, kind, entry.run, LOADED, entry.job, entry.target)])
        _enter(spark, ledger, [Entry(process, day, kind, staged[0].run, DONE)])
        for entry in staged:
            remove(spark, entry.path)
    return [LoadStatus(e.job, e.target, kind, not done and e.job not in loaded, ()) for e in staged]


def _stage(spark, plans, process, day, load_user, kind, parallel, type_mode, options):
    """Store every feed's rows; (entries, statuses), no entries if any feed fails."""
    run = uuid.uuid4().hex

    def stage(plan: FeedPlan) -> tuple[Entry, LoadStatus]:
        path = fresh_path(spark, "staged")
        entry = Entry(process, day, kind, run, STAGED, plan.job, plan.target, path)
        try:
            rows = feed_rows(spark, plan, day, load_user, **options)
            findings = tuple(_checked(spark, plan, rows, type_mode))
            if passes(findings):
                rows.write.parquet(path)
            return entry, LoadStatus(plan.job, plan.target, kind, False, findings)
        except Exception as error:  # reported in the status
            message = f"{type(error).__name__}: {error}"
            return entry, LoadStatus(plan.job, plan.target, kind, False, (), message)

    with ThreadPoolExecutor(parallel) as pool:
        both = list(pool.map(stage, plans))
    statuses = [status for _, status in both]
    if any(s.error or not passes(s.findings) for s in statuses):
        for entry, _ in both:
            remove(spark, entry.path)
        return None, statuses
    return [entry for entry, _ in both], statuses
