"""Whole jobs: extract and load feeds, flatten and load the wide table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stammwerk.functions.load_metadata import BOOK_DATE, load_metadata, stamp
from stammwerk.operators.extract import extract_feed
from stammwerk.operators.flatten import TieBreaks, current_of, flatten, read_entities
from stammwerk.operators.gate import STRICT, Finding, check_frame, describe_target, passes
from stammwerk.operators.versions import AS_WRITTEN, CHANGE_DATE, gather_columns
from stammwerk.plans.entities import FULL_CHAIN, SHORT_CHAIN, Entity
from stammwerk.plans.feeds import DELTA, INITIAL, NINE_FEEDS, FeedSpec
from stammwerk.sinks.writers import bucket_columns, resolve_target, write_table
from stammwerk.sources.feed_config import FeedPlan, expand_feeds, feed_plans, read_feed_config
from stammwerk.sources.tables import BOUND_DATE, read_source, read_sql_file

# Where a feed's rows come from: its built-in specification, or the configuration's SQL.
SPEC = "spec"
TEXT = "text"

# Fixed value: the source system stamped on the wide table.
FLATTEN_SOURCE_SYSTEM = "partnerdata"


@dataclass(frozen=True)
class LoadStatus:
    job: str
    target: str
    load_type: str
    written: bool
    findings: tuple[Finding, ...]
    error: str | None = None

    @property
    def failed_checks(self) -> list[str]:
        return [f"{f.check}:{f.field}" if f.field else f.check for f in self.findings if not f.ok]


def status_frame(spark: SparkSession, statuses: Sequence[LoadStatus]) -> DataFrame:
    rows = [(s.job, s.target, s.load_type, s.written, s.failed_checks, s.error) for s in statuses]
    return spark.createDataFrame(
        rows,
        "job string, target string, load_type string, written boolean,"
        " failed_checks array<string>, error string",
    )


def gated_load(
    df: DataFrame,
    target: str,
    load_type: str,
    partition_columns: Sequence[str] | None = None,
    cluster_columns: Sequence[str] | None = None,
    type_mode: str = STRICT,
    job: str = "",
    **options,
) -> LoadStatus:
    """Write ``df`` only if it fits the target; a misfit leaves the target untouched."""
    spark = df.sparkSession
    name = resolve_target(spark, target)
    stated = (
        None
        if cluster_columns is None
        else bucket_columns(cluster_columns, partition_columns or ())
    )
    findings = check_frame(
        df.schema, describe_target(spark, name, type_mode), partition_columns, stated, type_mode
    )
    ok = passes(findings)
    if ok:
        write_table(
            df, name, load_type, partition_columns or (), cluster_columns or (), **options
        )
    return LoadStatus(job, target, load_type, ok, tuple(findings))


def feed_rows(
    spark: SparkSession,
    plan: FeedPlan,
    book_date: date | str,
    load_user: str,
    source_schema: str | None = None,
    order: str = AS_WRITTEN,
    queries: str = SPEC,
    hub_join: str | None = None,
    specs: Mapping[str, FeedSpec] | None = None,
) -> DataFrame:
    """The rows of one feed, extracted and stamped.

    By ``queries="spec"`` a feed is extracted by the specification its configuration declares,
    or by the built-in one of the nine known feeds, whatever SQL the configuration holds;
    others by their SQL. ``queries="text"`` runs the SQL of every feed that has some. A
    delta needs the date it starts from.
    """
    if queries not in (SPEC, TEXT):
        raise ValueError(f"queries must be {SPEC!r} or {TEXT!r}, not {queries!r}")
    if plan.load_type == DELTA and plan.changed_since is None:
        raise ValueError(f"the delta load of {plan.feed} needs changed_since")
    spec = plan.spec or (specs or NINE_FEEDS).get(plan.feed)
    if plan.query and (queries == TEXT or spec is None):
        args = {BOUND_DATE: plan.changed_since} if plan.load_type == DELTA else None
        rows = read_source(spark, sql=plan.query, args=args)
    elif spec is not None:
        rows = extract_feed(
            spark,
            spec,
            source_schema,
            load_type=plan.load_type,
            changed_since=plan.changed_since,
            order=order,
            hub_join=hub_join,
        )
    else:
        raise ValueError(f"{plan.feed} is no known feed and has neither a specification nor an {plan.load_type} query")
    metadata = load_metadata(
        book_date, plan.source_system, load_user, plan.load_type, plan.metadata_fields
    )
    return stamp(rows, metadata)


def run_feed(
    spark: SparkSession,
    plan: FeedPlan,
    book_date: date | str,
    load_user: str,
    source_schema: str | None = None,
    order: str = AS_WRITTEN,
    type_mode: str = STRICT,
    queries: str = SPEC,
    hub_join: str | None = None,
    specs: Mapping[str, FeedSpec] | None = None,
    **options,
) -> LoadStatus:
    """Extract one feed, stamp it, check it against its target and load it."""
    rows = feed_rows(
        spark, plan, book_date, load_user, source_schema, order, queries, hub_join, specs
    )
    spark.sparkContext.setJobDescription(plan.job)
    # The book date is one value per load, so files need no gathering by it.
    gather = any(c != BOOK_DATE for c in plan.partition_columns)
    return gated_load(
        rows,
        plan.target,
        plan.load_type,
        plan.partition_columns or None,
        plan.cluster_columns or None,
        type_mode,
        plan.job,
        gather=gather,
        **options,
    )


def run_feeds(
    spark: SparkSession,
    config_path: str,
    book_date: date | str,
    load_user: str,
    load_type: str | None = None,
    changed_since: date | str | None = None,
    parallel: int = 4,
    raise_errors: bool = False,
    **options,
) -> list[LoadStatus]:
    """Run every feed of a configuration; feeds are independent jobs of one session.

    A feed that fails does not touch the others: its status carries the error. With
    ``raise_errors`` the first error is raised once all feeds are done. A configuration
    whose load strategy says ``load: No`` runs nothing.
    """
    config = read_feed_config(spark, config_path)
    plans = feed_plans(expand_feeds(config, load_type, changed_since))
    errors: list[Exception] = []

    def run(plan: FeedPlan) -> LoadStatus:
        try:
            return run_feed(spark, plan, book_date, load_user, **options)
        except Exception as error:  # reported in the status
            errors.append(error)
            message = f"{type(error).__name__}: {error}"
            return LoadStatus(plan.job, plan.target, plan.load_type, False, (), message)

    with ThreadPoolExecutor(parallel) as pool:
        statuses = list(pool.map(run, plans))
    if errors and raise_errors:
        raise errors[0]
    return statuses


def run_flatten(
    spark: SparkSession,
    target: str,
    book_date: date | str,
    load_user: str,
    inputs: Mapping[str, DataFrame] | None = None,
    source_schema: str | None = None,
    query_path: str | None = None,
    chain: Sequence[Entity] = SHORT_CHAIN,
    type_mode: str = STRICT,
    replace_book_date: bool = False,
    from_current: bool = False,
    **flatten_options,
) -> LoadStatus:
    """Flatten, stamp, check and append to the wide table, partitioned by book date.

    The wide rows come from ``query_path`` (a file with a query), from the given
    version tables, or from the entities' tables in ``source_schema``. ``from_current``
    says that inputs or tables hold current rows, as :func:`write_current_tables`
    stores them, so that nothing is ranked again.
    """
    spark.sparkContext.setJobDescription(f"flatten to {target}")
    if query_path:
        wide = read_sql_file(spark, query_path)
    else:
        wide = flatten(
            inputs or read_entities(spark, chain, source_schema, from_current),
            chain,
            from_current=from_current,
            **flatten_options,
        )
    stamped = stamp(wide, load_metadata(book_date, FLATTEN_SOURCE_SYSTEM, load_user))
    return gated_load(
        stamped,
        target,
        DELTA,
        partition_columns=[BOOK_DATE],
        type_mode=type_mode,
        job="flatten",
        gather=False,
        replace_partition={BOOK_DATE: str(book_date)} if replace_book_date else None,
    )


def write_current_tables(
    spark: SparkSession,
    schema: str,
    inputs: Mapping[str, DataFrame],
    tie_breaks: TieBreaks | None = None,
    buckets: int | None = None,
    base_path: str | None = None,
) -> list[str]:
    """Store each entity's current rows, replacing earlier content.

    Tables are bucketed by the columns they are joined by in the flatten chain and sorted by
    those, the entity's key and the change date. Managers are found by a code, not by
    a key of their own, and stay unbucketed: Spark knows a stored table's size and can
    broadcast it. A bucketed scan has no shuffle that AQE could split, so a join whose
    keys are known to be hot should be protected when flattening.
    """
    written = []
    for entity in FULL_CHAIN:
        if entity.name in inputs:
            sort = dict.fromkeys([*entity.join_keys, *entity.keys, CHANGE_DATE])
            gather_by = gather_columns(entity.join_keys, entity.keys)
            rows = current_of(entity, inputs[entity.name], tie_breaks, gather_by)
            written.append(
                write_table(
                    rows,
                    f"{schema}.{entity.view}",
                    INITIAL,
                    cluster_columns=entity.join_keys,
                    buckets=buckets,
                    path=base_path and f"{base_path}/{entity.view}",
                    sort_columns=list(sort),
                    gathered=True,
                )
            )
    return written
