"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.proxies import (
    ENTITY_INPUTS,
    FEED_QUERIES,
    FEEDS,
    HISTORY_INPUTS,
    OTHER_LAYOUT_MANAGERS,
    TIE_BREAKS,
    UNIT_CODE,
    VAULT,
    driver_table,
    proxy_frames,
)
from stammwerk.functions.load_metadata import load_metadata, stamp
from stammwerk.functions.unit_codes import FEED_LAYOUT, FLATTEN_LAYOUT, decode_unit
from stammwerk.operators.extract import extract
from stammwerk.operators.flatten import (
    flatten,
    read_entities,
    register_current_views,
    staging_to_flatten,
)
from stammwerk.operators.flatten_history import flatten_intervals
from stammwerk.operators.gate import WIDE
from stammwerk.operators.history import as_of_join, collapse_history, timeline
from stammwerk.operators.profile import estimates, merge_profiles, profile, store_profile
from stammwerk.operators.reconcile import compare_tables
from stammwerk.operators.rollup import cube_sets, roll_up
from stammwerk.operators.versions import AS_WRITTEN, LATEST, current_rows, pick_version
from stammwerk.plans.changes import delivered, extracted, take_changes
from stammwerk.plans.current_store import build_current_tables, refresh_current_tables
from stammwerk.plans.entities import ENTITIES, ENTITY_FEEDS, FULL_CHAIN, SHORT_CHAIN
from stammwerk.plans.feeds import DELTA, INITIAL
from stammwerk.plans.jobs import (
    TEXT,
    feed_rows,
    gated_load,
    run_feed,
    run_feeds,
    run_flatten,
    write_current_tables,
)
from stammwerk.plans.ledger import run_feeds_once
from stammwerk.plans.migration import converted, migrate
from stammwerk.session import fresh_path, remove, shuffles_removed, stored_at
from stammwerk.sinks.curve import read_curve, write_curve
from stammwerk.sinks.writers import create_target, write_path, write_table
from stammwerk.sources.feed_config import expand_feeds, feed_plans, read_feed_config
from stammwerk.sources.tables import read_source, read_sql_file
from stammwerk.streaming.current_stream import CurrentStream, run_stream

Query = Callable[[SparkSession, str], DataFrame]

BOOK_DATE = "2024-06-30"
LOAD_USER = "checks"
SCHEMA = "default"
STAGING_TIE_BREAK = ("SYS_START", "SYS_END", "MD_HDIFF_ATTRIBUTES")
CONFIG_FILE = os.path.join(os.path.dirname(__file__), "feeds.json")
SQL_FILE = os.path.join(os.path.dirname(__file__), "open_orders.sql")
FLATTEN_SQL_FILE = os.path.join(os.path.dirname(__file__), "partner_accounts.sql")


def _fresh_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """A table name and its folder that no other run uses."""
    path = fresh_path(spark, label)
    return f"{SCHEMA}.{path.rsplit('/', 1)[1].replace('-', '_')}", path


def _publish_text(spark: SparkSession, local_file: str) -> str:
    """Copy a small text of this repository to the shared folder."""
    with open(local_file, encoding="utf-8") as file:
        text = file.read()
    path = fresh_path(spark, "text")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def _shown(df: DataFrame) -> DataFrame:
    """A loaded table without its load time, the book date as text."""
    return df.withColumn("md_book_date", F.col("md_book_date").cast("string")).drop("md_load_date")


# --- feeds -------------------------------------------------------------------


def _feed(name: str, load_type: str, order: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = FEEDS[name]
        vault = proxy_frames(spark, sf_dir, {t: VAULT[t] for t in (feed.hub, feed.satellite)})
        return extract(
            feed,
            vault[feed.hub],
            vault[feed.satellite],
            load_type,
            FEED_QUERIES[name][1] if load_type == DELTA else None,
            order,
        )

    return run


def feed_queries() -> dict[str, Query]:
    found = {}
    for name, (part, _) in FEED_QUERIES.items():
        for load_type in (INITIAL, DELTA):
            found[f"feed_{part}_{load_type}"] = _feed(name, load_type, AS_WRITTEN)
            found[f"feed_{part}_{load_type}_latest"] = _feed(name, load_type, LATEST)
    return found


# Feeds whose changes are taken in by runs, and the last change date of the first run.
CHANGE_FEEDS = {
    "Partner_Info": "2001-01-01",
    "Partner_Filialkunde": "1999-01-01",
    "Partner_Cust_Support": "1999-01-01",
    "Partner_Industry": "2024-01-15",
}


def _taken(spark: SparkSession, sf_dir: str, name: str, diff: bool = False) -> str:
    """A schema with the changes of a feed taken in by three runs.

    The first has a part of the older versions and of the hub, the second all of both, old
    versions that arrive late included; the third finds nothing new. With ``diff`` the
    versions' digest is one of their attributes.
    """
    feed = FEEDS[name]
    vault = proxy_frames(spark, sf_dir, {t: VAULT[t] for t in (feed.hub, feed.satellite)})
    hub, satellite = vault[feed.hub], vault[feed.satellite]
    if diff:
        attributes = F.to_json(F.struct(*feed.satellite_columns))
        satellite = satellite.withColumn(feed.tie_break, F.md5(attributes))
    until = F.lit(CHANGE_FEEDS[name]).cast(satellite.schema["TSAEND"].dataType)
    some = F.pmod(F.xxhash64(feed.key, "SYS_START", "SYS_END"), F.lit(10)) > 0
    schema = _fresh_schema(spark, "changes")
    take_changes(feed, hub.where(F.pmod(F.xxhash64(feed.key), F.lit(20)) > 0),
                 satellite.where((F.col("TSAEND") <= until) & some), schema)
    for _ in range(2):
        take_changes(feed, hub, satellite, schema)
    return schema


def _changes(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A feed's extract as it stands after its changes were taken in."""
        return extracted(spark, FEEDS[name], _taken(spark, sf_dir, name))

    return run


def changes_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the runs of the partner feed delivered last of each partner."""
    name = "Partner_Info"
    rows = delivered(spark, FEEDS[name], _taken(spark, sf_dir, name, diff=True))
    last = pick_version(rows, ["PARTID"], [F.desc("_run")])
    return last.select("PARTID", *FEEDS[name].satellite_columns)


# --- current rows and flatten ------------------------------------------------


def _current(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        versions = proxy_frames(spark, sf_dir, {name: ENTITY_INPUTS[name]})[name]
        return current_rows(versions, ENTITIES[name].keys, TIE_BREAKS[name])

    return run


def current_queries() -> dict[str, Query]:
    return {f"current_{name}": _current(name) for name in ENTITY_INPUTS}


def current_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counterparties of partners, read through the registered current views."""
    register_current_views(proxy_frames(spark, sf_dir, ENTITY_INPUTS), TIE_BREAKS)
    return spark.sql("""
        SELECT p.PARTID, p.info_order, c.counterparty_id, c.GESCHPARTKLS
        FROM v_partner_info_current p
        JOIN v_partner_counterparty_current c ON c.PARTID = p.PARTID
    """)


def _fresh_schema(spark: SparkSession, label: str) -> str:
    path = fresh_path(spark, label)
    schema = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{path}'")
    return schema


def _stored_current(spark: SparkSession, sf_dir: str, chain=FULL_CHAIN) -> str:
    """A schema with the current tables of a chain's entities."""
    schema = _fresh_schema(spark, "current")
    inputs = proxy_frames(spark, sf_dir, {e.name: ENTITY_INPUTS[e.name] for e in chain})
    write_current_tables(spark, schema, inputs, TIE_BREAKS)
    return schema


def current_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with their support units, read from the stored current tables."""
    schema = _stored_current(spark, sf_dir)
    return spark.sql(f"""
        SELECT a.counterparty_id, a.sequence_no, a.segkss, s.BETREUEINHID
        FROM {schema}.v_partner_filalkunde_current a
        JOIN {schema}.v_partner_cust_support_current s
          ON s.counterparty_id = a.counterparty_id AND s.sequence_no = a.sequence_no
    """)


def _from_current(chain) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Flattened from the stored current tables; nothing is ranked again."""
        schema = _stored_current(spark, sf_dir, chain)
        stored_rows = read_entities(spark, chain, schema, current=True)
        return flatten(stored_rows, chain, from_current=True, gathered=True)

    return run


# Rows of the entities up to these change dates are stored first, the others come as a delta.
STORED_UNTIL = {"natural_person": "2024-01-20", "org_legal_person": "2024-01-20"}
STORED_UNTIL_ELSE = "1999-06-30"


def _refreshed(spark: SparkSession, inputs: dict[str, DataFrame]) -> str:
    """A schema with current tables that were stored from older versions and then refreshed.

    The delta holds the newer versions, some old ones that arrive late, and some that were
    delivered before.
    """
    first, delta = {}, {}
    for name, versions in inputs.items():
        key = F.hash(*ENTITIES[name].keys)
        until = F.lit(STORED_UNTIL.get(name, STORED_UNTIL_ELSE)).cast(versions.schema["TSAEND"].dataType)
        early = (F.col("TSAEND") <= until) & (F.pmod(key, F.lit(10)) > 0)
        first[name] = versions.where(early)
        delta[name] = versions.where(~early | (F.pmod(key, F.lit(7)) == 0))
    schema = _fresh_schema(spark, "refreshed")
    build_current_tables(spark, schema, first, TIE_BREAKS)
    refresh_current_tables(schema, delta, TIE_BREAKS)
    return schema


def _refreshed_current(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """An entity's current rows, stored and refreshed."""
        inputs = proxy_frames(spark, sf_dir, {name: ENTITY_INPUTS[name]})
        return spark.table(f"{_refreshed(spark, inputs)}.{ENTITIES[name].view}")

    return run


def flatten_short_from_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _refreshed(spark, short_inputs(spark, sf_dir))
    stored_rows = read_entities(spark, SHORT_CHAIN, schema, current=True)
    return flatten(stored_rows, SHORT_CHAIN, from_current=True, gathered=True)


def short_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return proxy_frames(spark, sf_dir, {e.name: ENTITY_INPUTS[e.name] for e in SHORT_CHAIN})


def _flattened(inputs: dict[str, DataFrame], chain, tie_breaks=TIE_BREAKS, **options) -> DataFrame:
    """Current rows flattened; every counterparty has a few accounts only."""
    return flatten(inputs, chain, tie_breaks, gathered=True, managers_first=True, **options)


def flatten_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(short_inputs(spark, sf_dir), SHORT_CHAIN)


def flatten_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(proxy_frames(spark, sf_dir, ENTITY_INPUTS), FULL_CHAIN)


def flatten_full_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full chain; the join of accounts to partners may be split on both sides."""
    inputs = proxy_frames(spark, sf_dir, ENTITY_INPUTS)
    return _flattened(inputs, FULL_CHAIN, protect=["account"], staged=True)


def flatten_short_other_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit code read in the flattening query's order."""
    texts = {e.name: ENTITY_INPUTS[e.name] for e in SHORT_CHAIN} | {"manager": OTHER_LAYOUT_MANAGERS}
    inputs = proxy_frames(spark, sf_dir, texts)
    return _flattened(inputs, SHORT_CHAIN, layout=FLATTEN_LAYOUT)


def flatten_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = proxy_frames(spark, sf_dir, HISTORY_INPUTS)
    return flatten(inputs, FULL_CHAIN, all_versions=True, gathered=True, staged=True)


def flatten_all_versions_protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every join written so that both sides may be split."""
    inputs = proxy_frames(spark, sf_dir, HISTORY_INPUTS)
    every = [e.name for e in FULL_CHAIN[1:]]
    return flatten(inputs, FULL_CHAIN, all_versions=True, protect=every, gathered=True, staged=True)


# --- histories ---------------------------------------------------------------

# What makes two versions of an entity differ.
ATTRIBUTES = {
    "info": ("PARTKLS",),
    "natural_person": ("STANG",),
    "counterparty": ("PARTID", "GESCHPARTKLS"),
    "account": ("PARTID", "segkss"),
    "support": ("acct_mngr_unit_id",),
    "manager": ("ERTRAGSTELLE",),
}
PARTNER_ENTITIES = ("info", "natural_person", "org_legal_person", "postal_address")


def _history(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Validity intervals of an entity's versions."""
        versions = proxy_frames(spark, sf_dir, {name: ENTITY_INPUTS[name]})[name]
        return collapse_history(versions, ENTITIES[name].keys, ATTRIBUTES[name], TIE_BREAKS[name])

    return run


def timeline_partner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is known of a partner, a row per interval in which nothing changes."""
    inputs = proxy_frames(spark, sf_dir, {n: ENTITY_INPUTS[n] for n in PARTNER_ENTITIES})
    aligned = timeline(inputs, ["PARTID"], TIE_BREAKS)
    return aligned.select(
        "PARTID", "valid_from", "valid_to",
        *[F.col(f"{n}.{c}").alias(f"{n}_{c}") for n in PARTNER_ENTITIES for c in inputs[n].columns if c != "PARTID"],
    )


def as_of_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts' versions with their partner as it was then."""
    inputs = proxy_frames(spark, sf_dir, {n: ENTITY_INPUTS[n] for n in ("account", "info")})
    found = as_of_join(inputs["account"], inputs["info"], ["PARTID"], "TSAEND", "info", TIE_BREAKS["info"])
    return found.select(
        *inputs["account"].columns,
        *[F.col(f"info.{c}").alias(f"info_{c}") for c in inputs["info"].columns if c != "PARTID"],
    )


def intervals_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The short chain over time, every version of every entity aligned."""
    return flatten_intervals(short_inputs(spark, sf_dir), SHORT_CHAIN, TIE_BREAKS)


def stream_current_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts' current rows, kept by a stream that meets their versions in four files."""
    account = ENTITIES["account"]
    versions = proxy_frames(spark, sf_dir, {"account": ENTITY_INPUTS["account"]})["account"]
    folder = fresh_path(spark, "arriving")
    versions.repartition(4, "TSAEND").write.parquet(folder)
    stream = CurrentStream(
        f"{_fresh_schema(spark, 'stream')}.{account.view}", account.keys, account.join_keys, TIE_BREAKS["account"]
    )
    run_stream(spark, stream, folder, versions.schema, fresh_path(spark, "checkpoint"), files_per_batch=1)
    return spark.table(stream.view)


# --- reconciliation ----------------------------------------------------------


def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy with some orders lost, some doubled and some of another price."""
    orders = _orders(spark, sf_dir)
    path = fresh_path(spark, "copy")
    key = F.col("o_orderkey")
    kept = orders.where((key < 300) | (key > 309)).withColumn(
        "o_totalprice", F.when(key.between(900, 904), F.lit(1.0)).otherwise(F.col("o_totalprice"))
    )
    write_path(kept.union(orders.where(key.between(600, 607))), path, INITIAL)
    found = compare_tables(orders, spark.read.parquet(path), "o_orderkey")
    return found.differences.withColumn("equal", F.lit(found.equal))


# --- profiles ----------------------------------------------------------------


def profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines profiled by three loads and merged: exact parts, and whether estimates are close."""
    lines = proxy_frames(spark, sf_dir, {"lines": VAULT["partner_gesch_partner_s"]})["lines"]
    table = f"{_fresh_schema(spark, 'profiles')}.loads"
    loads = {"2024-06-28": "R", "2024-06-29": "A", BOOK_DATE: "N"}
    for book_date, flag in loads.items():
        rows = lines.where(F.col("GESCHPARTKLS") == flag)
        for _ in range(2):
            store_profile(profile(rows, ["MD_HKEY_GESCH_PARTNER_ID"]), table, book_date)
    found = estimates(merge_profiles(spark.table(table)))
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in lines.columns])
    counts = exact.unpivot([], [F.col(c) for c in lines.columns], "column", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= 0.08 * F.col("exact") + 1
    return found.join(counts, "column").select("column", "rows", "nulls", "repeats", near.alias("near"))


# --- totals ------------------------------------------------------------------


def flatten_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and different partners of the wide table by branch, department and manager."""
    groups = ["branch", "acct_mngr_dept_id", "acct_mngr_id"]
    wide = flatten_short(spark, sf_dir)
    return roll_up(wide, groups, cube_sets(groups), "PARTID", {"quantity": F.coalesce("segkss", F.lit(0.0))})


# --- scalar functions and metadata -------------------------------------------


def unit_code_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr(UNIT_CODE.format(k="l_suppkey"))
    columns = [F.col("l_orderkey"), F.col("l_linenumber"), code.alias("code")]
    for prefix, layout in (("feed", FEED_LAYOUT), ("flatten", FLATTEN_LAYOUT)):
        columns += [c.alias(f"{prefix}_{p}") for p, c in decode_unit(code, layout).items()]
    return driver_table(spark, sf_dir, "lineitem").select(columns)


def unit_code_decode_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes with letters in some parts: those parts come out null."""
    code = F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1), F.lit("0A"), F.col("o_orderkey"))
    parts = decode_unit(code, strict=False)
    return driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", *[c.alias(p) for p, c in parts.items()]
    )


def stamp_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers stamped; the load time is shown as being one value for all rows."""
    metadata = load_metadata(BOOK_DATE, "partnerdata", LOAD_USER)
    stamped = stamp(driver_table(spark, sf_dir, "customer"), metadata)
    same = F.col("md_load_date") == F.current_timestamp()
    return _shown(stamped.withColumn("one_load_date", same))


# --- sources -----------------------------------------------------------------


def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query wins over a table given with it."""
    driver_table(spark, sf_dir, "orders").createOrReplaceTempView("scan_orders")
    return read_source(
        spark,
        sql="SELECT o_orderkey, o_totalprice FROM scan_orders WHERE o_orderstatus = 'O'",
        table="scan_orders",
    )


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = _fresh_table(spark, "scan")
    write_table(driver_table(spark, sf_dir, "orders"), table, INITIAL, path=path)
    return read_source(spark, table=table)


def scan_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, path=f"{sf_dir}/supplier.parquet")


def scan_sql_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver_table(spark, sf_dir, "orders").createOrReplaceTempView("scan_orders")
    return read_sql_file(spark, _publish_text(spark, SQL_FILE))


def scan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = driver_table(spark, sf_dir, "orders")
    orders.where("o_orderstatus = 'F'").createOrReplaceTempView("finished_orders")
    return read_source(spark, table="finished_orders")


def scan_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers read through a stated schema and joined to an empty frame of a stated schema."""
    stated = T.StructType(
        [T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())]
    )
    customers = spark.read.schema(stated).parquet(f"{sf_dir}/customer.parquet")
    none = spark.createDataFrame([], "c_custkey bigint, note string")
    return customers.join(none, "c_custkey", "left")


def bound_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    driver_table(spark, sf_dir, "orders").createOrReplaceTempView("scan_orders")
    return read_source(
        spark,
        sql="SELECT o_orderkey, o_orderdate FROM scan_orders"
        " WHERE o_orderdate > '{{Prev_Working_date}}'",
        args={"Prev_Working_date": "2000-06-30"},
    )


# --- feed configuration ------------------------------------------------------


def _register_vault(spark: SparkSession, sf_dir: str) -> None:
    for name, frame in proxy_frames(spark, sf_dir, VAULT).items():
        frame.createOrReplaceTempView(name)


def _feed_plan(load_type: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The rows each configured feed extracts, next to what its plan says."""
        _register_vault(spark, sf_dir)
        config = read_feed_config(spark, _publish_text(spark, CONFIG_FILE))
        feeds = expand_feeds(config, load_type, "1999-06-30")
        extracts = None
        for plan in feed_plans(feeds):
            args = {"Prev_Working_date": plan.changed_since} if load_type == DELTA else None
            rows = read_source(spark, sql=plan.query, args=args).select(
                F.lit(plan.job).alias("job"),
                F.lit(plan.target).alias("target"),
                F.lit(",".join(plan.partition_columns)).alias("partition_columns"),
                F.lit(",".join(plan.cluster_columns)).alias("cluster_columns"),
                "PARTID",
                "TSAEND",
                "SYS_END",
            )
            extracts = rows if extracts is None else extracts.union(rows)
        return extracts

    return run


# --- sinks -------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "orders")


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = _fresh_table(spark, "overwrite")
    orders = _orders(spark, sf_dir)
    write_table(orders.where("o_orderstatus = 'F'"), table, INITIAL, path=path)
    write_table(orders, table, INITIAL)
    return spark.table(table)


def sink_initial_dynamic_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An initial load replaces all partitions, whatever the session's overwrite mode."""
    table, path = _fresh_table(spark, "dynamic")
    orders = _orders(spark, sf_dir)
    write_table(orders, table, INITIAL, partition_columns=["o_orderstatus"], path=path)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        write_table(orders.where("o_orderstatus = 'F'"), table, INITIAL)
    finally:
        spark.conf.set(mode, before)
    return spark.table(table)


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun of an append doubles the rows."""
    path = fresh_path(spark, "append")
    write_path(_orders(spark, sf_dir), path, INITIAL)
    write_path(_orders(spark, sf_dir), path, DELTA)
    return spark.read.parquet(path)


def sink_append_fewer_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = _fresh_table(spark, "fewer")
    orders = _orders(spark, sf_dir)
    write_table(orders, table, INITIAL, path=path)
    write_table(orders.select("o_custkey", "o_orderkey"), table, DELTA)
    return spark.table(table)


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "partitioned")
    write_path(_orders(spark, sf_dir), path, INITIAL, partition_columns=["o_orderstatus"])
    return spark.read.parquet(path)


def sink_partition_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the partition that is loaded again changes."""
    table, path = _fresh_table(spark, "replaced")
    orders = _orders(spark, sf_dir)
    write_table(orders, table, INITIAL, partition_columns=["o_orderstatus"], path=path)
    again = orders.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.lit(0.0))
    write_table(again, table, DELTA, replace_partition={"o_orderstatus": "P"})
    return spark.table(table)


def sink_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = _fresh_table(spark, "bucketed")
    orders = _orders(spark, sf_dir)
    for load_type in (INITIAL, DELTA):
        write_table(
            orders, table, load_type, ["o_orderstatus"], ["o_custkey", "o_orderstatus"],
            buckets=8, path=path,
        )
    return spark.table(table)


def sink_clustered_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "clustered")
    write_path(_orders(spark, sf_dir), path, INITIAL, cluster_columns=["o_custkey", "o_orderdate"])
    return spark.read.parquet(path)


CURVE_COLUMNS = ["l_partkey", "l_suppkey", "l_shipdate"]


def _curve_lines(spark: SparkSession, sf_dir: str) -> str:
    """All lines in two loads along a curve over three columns."""
    path = fresh_path(spark, "curve")
    lines = driver_table(spark, sf_dir, "lineitem")
    for half in ("l_returnflag = 'N'", "l_returnflag <> 'N'"):
        write_curve(lines.where(half), path, CURVE_COLUMNS, files=32)
    return path


def sink_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_curve(spark, _curve_lines(spark, sf_dir))


def _curve_range(column: str, low: object, high: object) -> Query:
    """The lines of a range of one cluster column, from the files that may hold some."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_curve(spark, _curve_lines(spark, sf_dir), {column: (low, high)})

    return run


# --- gate --------------------------------------------------------------------


def _gated(
    change: Callable[[DataFrame], DataFrame], mode: str, held: Callable | None = None, **layout
) -> Query:
    """Finished orders are in the target; a changed frame of all orders is then appended.

    ``held`` changes the columns the target is made with.

    The result is the target afterwards, and whether the gate let the load through.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table, path = _fresh_table(spark, "gated")
        base = _orders(spark, sf_dir).select(
            F.col("o_orderkey").cast("int").alias("o_orderkey"),
            F.col("o_custkey").cast("int").alias("o_custkey"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            F.to_date("o_orderdate").alias("o_orderdate"),
            "o_orderstatus",
        )
        first = held(base) if held else base
        create_target(
            spark, table, first.schema, ["o_orderstatus"], ["o_custkey", "o_orderkey"],
            buckets=4, path=path,
        )
        write_table(first.where("o_orderstatus = 'F'"), table, INITIAL, buckets=4)
        status = gated_load(change(base), table, DELTA, type_mode=mode, buckets=4, **layout)
        return spark.table(table).select(
            F.col("o_orderkey").cast("int").alias("o_orderkey"),
            "o_custkey",
            F.col("o_totalprice").cast("double").alias("o_totalprice"),
            F.col("o_orderdate").cast("string").alias("o_orderdate"),
            "o_orderstatus",
            F.lit(status.written).alias("written"),
            F.lit(",".join(status.failed_checks)).alias("failed_checks"),
        )

    return run


def _same(df: DataFrame) -> DataFrame:
    return df


def _wider(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


def gate_wide_narrowing_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target of narrower columns takes no wider ones, in either mode."""
    table, path = _fresh_table(spark, "narrow")
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    narrow = orders.select(
        F.col("o_orderkey").cast("int").alias("o_orderkey"),
        F.col("o_totalprice").cast("float").alias("o_totalprice"),
    )
    create_target(spark, table, narrow.schema, path=path)
    write_table(narrow, table, INITIAL)
    status = gated_load(orders, table, DELTA, type_mode=WIDE)
    return spark.table(table).select(
        "o_orderkey",
        F.lit(status.written).alias("written"),
        F.lit(",".join(status.failed_checks)).alias("failed_checks"),
    )


def gate_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders marked with the outcome of a load into a table that does not exist."""
    table, _ = _fresh_table(spark, "absent")
    orders = _orders(spark, sf_dir)
    status = gated_load(orders, table, DELTA, type_mode=WIDE)
    return orders.select(
        "o_orderkey",
        F.lit(status.written).alias("written"),
        F.lit(",".join(status.failed_checks)).alias("failed_checks"),
    )


def _migrated(change: Callable[[DataFrame], DataFrame], mode: str, **layout) -> Query:
    """As ``_gated``, but the target is made to fit the frame before it is loaded.

    The result has the steps and the reasons why there are none as well.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table, path = _fresh_table(spark, "migrated")
        base = _orders(spark, sf_dir).select(
            F.col("o_orderkey").cast("int").alias("o_orderkey"),
            F.col("o_custkey").cast("int").alias("o_custkey"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
            "o_orderstatus",
            "o_orderpriority",
        )
        create_target(spark, table, base.schema, ["o_orderstatus"], ["o_custkey"], buckets=4, path=path)
        write_table(base.where("o_orderstatus = 'F'"), table, INITIAL)
        frame = change(base)
        plan = migrate(spark, table, frame.schema, mode=mode, **layout)
        status = gated_load(converted(frame, plan), table, DELTA, type_mode=mode, **layout)
        held = spark.table(table)
        return held.select(
            "o_orderkey",
            "o_custkey",
            F.col("o_totalprice").cast("double").alias("o_totalprice"),
            "o_orderstatus",
            "o_orderpriority",
            (F.col("o_note") if "o_note" in held.columns else F.lit(None).cast("string")).alias("o_note"),
            F.lit(status.written).alias("written"),
            F.lit("; ".join(map(str, plan.steps))).alias("steps"),
            F.lit("; ".join(r.reason for r in plan.refused)).alias("refused"),
        )

    return run


def _noted(df: DataFrame) -> DataFrame:
    return df.withColumn("o_note", F.concat(F.lit("late "), F.col("o_orderpriority")))


def migration_queries() -> dict[str, Query]:
    return {
        "migrate_missing_field": _migrated(_noted, "strict"),
        "migrate_wider": _migrated(lambda df: _noted(_wider(df)), "wide"),
        "migrate_wider_bucket": _migrated(lambda df: df.withColumn("o_custkey", F.col("o_custkey").cast("bigint")), "wide"),
        "migrate_narrower_frame": _migrated(lambda df: df.withColumn("o_totalprice", F.floor("o_totalprice").cast("int")), "strict"),
        "migrate_layout": _migrated(
            _same, "strict", partition_columns=["o_orderpriority", "o_orderstatus"],
            cluster_columns=["o_orderkey", "o_custkey"],
        ),
        "migrate_refused": _migrated(lambda df: _noted(_wider(df)).drop("o_orderstatus"), "strict"),
    }


def gate_queries() -> dict[str, Query]:
    return {
        "gate_ok": _gated(_same, "strict"),
        "gate_extra_target_field": _gated(lambda df: df.drop("o_totalprice"), "strict"),
        "gate_missing_field": _gated(lambda df: df.withColumn("o_note", F.lit("x")), "strict"),
        "gate_type_mismatch_strict": _gated(_wider, "strict"),
        "gate_wide": _gated(_same, "wide", held=_wider),
        "gate_partition": _gated(_same, "strict", partition_columns=["o_orderdate"]),
        "gate_partition_absent": _gated(lambda df: df.drop("o_orderstatus"), "strict"),
        "gate_cluster_set": _gated(_same, "strict", cluster_columns=["o_orderkey", "o_custkey"]),
        "gate_cluster_other": _gated(_same, "strict", cluster_columns=["o_orderkey"]),
        "gate_missing_table": gate_missing_table,
        "gate_wide_narrowing_blocked": gate_wide_narrowing_blocked,
        "gated_write_blocked": _gated(
            lambda df: df.withColumnRenamed("o_totalprice", "O_TOTALPRICE"), "strict"
        ),
    }


# --- jobs --------------------------------------------------------------------


def job_run_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial load, then a delta, of the partner feed into its target."""
    _register_vault(spark, sf_dir)
    table, path = _fresh_table(spark, "partner_stg")
    config = read_feed_config(spark, _publish_text(spark, CONFIG_FILE))
    feed = _feed("Partner_Info", INITIAL, AS_WRITTEN)(spark, sf_dir)
    metadata = load_metadata(BOOK_DATE, "", LOAD_USER, INITIAL,
                             ["book_date", "load_date", "load_user", "load_type"])
    create_target(
        spark, table, stamp(feed, metadata).schema, ["md_book_date"], ["PARTID"],
        buckets=4, path=path,
    )
    for load_type, book_date in ((INITIAL, "2024-06-28"), (DELTA, BOOK_DATE)):
        feeds = expand_feeds(config, load_type, "2001-01-01")
        (plan,) = feed_plans(feeds.where("feed = 'Partner_Info'").withColumn("target", F.lit(table)))
        run_feed(spark, plan, book_date, LOAD_USER, type_mode=WIDE, buckets=4)
    return _shown(spark.table(table))


FEED_METADATA = ["book_date", "load_date", "load_user", "load_type"]


def _feeds_config(spark: SparkSession, sf_dir: str, schema: str, names, extra=None) -> str:
    """A target per feed in ``schema``, and a configuration of these feeds."""
    entities = {}
    for name in names:
        rows = _feed(name, INITIAL, AS_WRITTEN)(spark, sf_dir)
        metadata = load_metadata(BOOK_DATE, "", LOAD_USER, INITIAL, FEED_METADATA)
        key = FEEDS[name].hub_columns[0]
        create_target(
            spark, f"{schema}.{name.lower()}", stamp(rows, metadata).schema, ["md_book_date"],
            [key], buckets=4,
        )
        entities[name] = {
            # The specification is used, not this text, which Spark could not run.
            "initial_query": "SELECT * FROM nowhere QUALIFY 1 = 1",
            "delta_query": "SELECT * FROM nowhere QUALIFY 1 = 1",
            "target_dataset": schema,
            "target_tableName": name.lower(),
            "cluster_enabled": "Yes",
            "cluster_columns": [key],
            "static_metadata_fields": FEED_METADATA,
        }
    config = {
        "process_Info": {"process_descr": "daily", "source_system": "vault",
                         "tenant_process": "stage", "version": "1"},
        "feedEntities": entities | (extra or {}),
        "loadStrategy": {"load": "Yes", "load_type": "{{load_type}}",
                         "partition": {"enabled": "Yes", "partition_by": "{{book_date}}"}},
    }
    path = fresh_path(spark, "config")
    text = json.dumps(config)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def _loaded(spark: SparkSession, schema: str, name: str) -> DataFrame:
    return spark.table(f"{schema}.{name.lower()}").select(
        F.lit(name).alias("feed"),
        F.col(FEEDS[name].hub_columns[0]).cast("long").alias("key"),
        "TSAEND",
        "MD_HDIFF_ATTRIBUTES",
        F.col("md_book_date").cast("string").alias("md_book_date"),
        "md_load_type",
    )


def job_run_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine feeds of a configuration, initial and delta, read back from their targets."""
    _register_vault(spark, sf_dir)
    schema = _fresh_schema(spark, "feeds")
    config = _feeds_config(spark, sf_dir, schema, FEEDS)
    for load_type, book_date, since in (
        (INITIAL, "2024-06-28", None), (DELTA, BOOK_DATE, "2000-06-30")
    ):
        run_feeds(
            spark, config, book_date, LOAD_USER, load_type, since, raise_errors=True,
            type_mode=WIDE, specs=FEEDS,
        )
    loaded = [_loaded(spark, schema, name) for name in FEEDS]
    union = loaded[0]
    for rows in loaded[1:]:
        union = union.union(rows)
    return union


def job_run_declared_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed beyond the nine, declared by its fields, with a filter on an integer column."""
    tables = {"line_orders_h": "SELECT o_orderkey AS HK, o_orderkey AS ORDER_ID FROM {orders}",
              "line_versions_s": """
                  SELECT l_orderkey AS HK, l_quantity AS QUANTITY, l_linenumber AS LINE, l_shipdate AS TSAEND,
                         l_suppkey AS SYS_START, l_partkey AS SYS_END, l_returnflag AS MD_HDIFF_ATTRIBUTES
                  FROM {lineitem}"""}
    for name, frame in proxy_frames(spark, sf_dir, tables).items():
        frame.createOrReplaceTempView(name)
    schema = _fresh_schema(spark, "declared")
    spec = {"hub": "line_orders_h", "satellite": "line_versions_s", "key": "HK", "hub_columns": ["ORDER_ID"],
            "satellite_columns": ["QUANTITY"], "equals": {"LINE": "2"}}
    config = _feeds_config(spark, sf_dir, schema, [], {"Lines": {
        "spec": spec, "target_dataset": schema, "target_tableName": "lines",
        "static_metadata_fields": FEED_METADATA}})
    (plan,) = feed_plans(expand_feeds(read_feed_config(spark, config), INITIAL))
    rows = feed_rows(spark, plan, BOOK_DATE, LOAD_USER)
    create_target(spark, plan.target, rows.schema, ["md_book_date"])
    for load_type, book_date, since in ((INITIAL, "2024-06-28", None), (DELTA, BOOK_DATE, "1999-06-30")):
        run_feeds(spark, config, book_date, LOAD_USER, load_type, since, raise_errors=True, type_mode=WIDE)
    return _shown(spark.table(plan.target))


def job_run_feeds_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine feeds, initial and delta, each run twice: every book date is there once."""
    _register_vault(spark, sf_dir)
    schema = _fresh_schema(spark, "once")
    config = _feeds_config(spark, sf_dir, schema, FEEDS)
    for load_type, book_date, since in (
        (INITIAL, "2024-06-28", None), (DELTA, BOOK_DATE, "2000-06-30")
    ):
        for _ in range(2):
            run_feeds_once(
                spark, config, book_date, LOAD_USER, f"{schema}.loads", load_type, since,
                type_mode=WIDE, specs=FEEDS,
            )
    loaded = [_loaded(spark, schema, name) for name in FEEDS]
    union = loaded[0]
    for rows in loaded[1:]:
        union = union.union(rows)
    return union


def run_feeds_one_fails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed's query fails; the others load, and every feed has a status."""
    _register_vault(spark, sf_dir)
    schema = _fresh_schema(spark, "one_fails")
    names = ("Partner_Info", "Partner_Counterparty")
    broken = {"Broken": {"initial_query": "SELECT * FROM no_such_table", "target_dataset": schema,
                         "target_tableName": "partner_info", "static_metadata_fields": FEED_METADATA}}
    config = _feeds_config(spark, sf_dir, schema, names, broken)
    statuses = run_feeds(spark, config, BOOK_DATE, LOAD_USER, INITIAL, type_mode=WIDE, specs=FEEDS)
    by_feed = {s.job.removeprefix("daily_vault_"): s for s in statuses}
    shown = [
        _loaded(spark, schema, name).select(
            "feed", "key", F.lit(by_feed[name].written).alias("written"),
            F.lit(by_feed[name].error is not None).alias("failed"),
        )
        for name in names
    ]
    failed = by_feed["Broken"]
    status = spark.range(1).select(
        F.lit("Broken").alias("feed"), F.lit(None).cast("long").alias("key"),
        F.lit(failed.written).alias("written"), F.lit(failed.error is not None).alias("failed"),
    )
    return shown[0].union(shown[1]).union(status)


def job_run_feeds_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both configured feeds run by their SQL texts, initial and delta."""
    _register_vault(spark, sf_dir)
    schema = _fresh_schema(spark, "texts")
    with open(CONFIG_FILE, encoding="utf-8") as file:
        config = json.load(file)
    for entity in config["feedEntities"].values():
        entity["target_dataset"] = schema
        entity["static_metadata_fields"] = FEED_METADATA
    path = fresh_path(spark, "config")
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(path)
    plans = feed_plans(expand_feeds(read_feed_config(spark, path), INITIAL))
    metadata = load_metadata(BOOK_DATE, "", LOAD_USER, INITIAL, FEED_METADATA)
    for plan in plans:
        rows = stamp(read_source(spark, sql=plan.query), metadata)
        create_target(spark, plan.target, rows.schema, plan.partition_columns, plan.cluster_columns,
                      buckets=4)
    for load_type, since in ((INITIAL, None), (DELTA, "1999-06-30")):
        run_feeds(spark, path, BOOK_DATE, LOAD_USER, load_type, since, raise_errors=True,
                  type_mode=WIDE, queries=TEXT)
    loaded = [
        spark.table(plan.target).select(F.lit(plan.feed).alias("feed"), "PARTID", "TSAEND",
                                        "SYS_END", "md_load_type")
        for plan in plans
    ]
    return loaded[0].union(loaded[1])


WIDE_SCHEMA = """
    PARTID bigint, PARTKLS string, info_TSAEND timestamp_ntz, info_order bigint,
    counterparty_counterparty_id bigint, counterparty_PARTID bigint, GESCHPARTKLS string,
    counterparty_TSAEND timestamp_ntz, account_counterparty_id bigint, account_sequence_no int,
    account_PARTID bigint, segkss double, account_TSAEND timestamp_ntz, account_supplier bigint,
    account_part bigint, support_counterparty_id bigint, support_sequence_no int,
    BETREUEINHID bigint, acct_mngr_unit_id bigint, support_TSAEND timestamp_ntz,
    support_part bigint, branch int, acct_mngr_id int, acct_mngr_dept_id int,
    acct_mngr_area int, ERTRAGSTELLE string, manager_TSAEND timestamp_ntz, manager_order bigint,
    manager_line int, manager_part bigint, md_book_date date, md_load_date timestamp,
    md_load_user string, md_source_system string"""


def job_run_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, path = _fresh_table(spark, "wide")
    create_target(spark, table, T.StructType.fromDDL(WIDE_SCHEMA), ["md_book_date"], path=path)
    run_flatten(
        spark, table, BOOK_DATE, LOAD_USER, short_inputs(spark, sf_dir),
        chain=SHORT_CHAIN, type_mode=WIDE, tie_breaks=TIE_BREAKS, gathered=True, managers_first=True,
    )
    return _shown(spark.table(table))


def job_run_flatten_query_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table loaded from a file with a query over the current views."""
    register_current_views(short_inputs(spark, sf_dir), TIE_BREAKS)
    table, path = _fresh_table(spark, "wide_query")
    query = _publish_text(spark, FLATTEN_SQL_FILE)
    schema = stamp(read_sql_file(spark, query), load_metadata(BOOK_DATE, "", LOAD_USER)).schema
    create_target(spark, table, schema, ["md_book_date"], path=path)
    run_flatten(spark, table, BOOK_DATE, LOAD_USER, query_path=query, type_mode=WIDE)
    return _shown(spark.table(table))


def feeds_to_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The initial feeds, renamed and flattened: the whole way from hubs to the wide table.

    Extracts, then their current rows, are stored: disk holds one feed's shuffles at a time.
    """
    staged, paths = {}, []
    for name, feed in ENTITY_FEEDS.items():
        path, extracted_rows = stored_at(_feed(feed, INITIAL, LATEST)(spark, sf_dir), name)
        staged[name] = staging_to_flatten(extracted_rows)
        paths.append(path)
    # The proxy account satellite holds no partner; its order's customer is the partner.
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    for name in ("counterparty", "account"):
        staged[name] = (
            staged[name]
            .drop("PARTID")
            .join(orders, F.col("counterparty_id") == F.col("o_orderkey"))
            .withColumnRenamed("o_custkey", "PARTID")
            .drop("o_orderkey")
        )
    schema = _fresh_schema(spark, "current")
    with shuffles_removed(spark):
        write_current_tables(spark, schema, staged, {n: STAGING_TIE_BREAK for n in staged})
    for path in paths:
        remove(spark, path)
    return flatten(read_entities(spark, FULL_CHAIN, schema, current=True), from_current=True, gathered=True)


def queries() -> dict[str, Query]:
    return {
        **feed_queries(),
        **{f"changes_{FEED_QUERIES[name][0]}": _changes(name) for name in CHANGE_FEEDS},
        "changes_delivered": changes_delivered,
        **current_queries(),
        "current_views": current_views,
        "current_tables": current_tables,
        "flatten_short": flatten_short,
        "flatten_full": flatten_full,
        "flatten_full_spread": flatten_full_spread,
        "flatten_all_versions": flatten_all_versions,
        "flatten_all_versions_protected": flatten_all_versions_protected,
        "flatten_short_other_layout": flatten_short_other_layout,
        "flatten_short_from_current": _from_current(SHORT_CHAIN),
        "flatten_full_from_current": _from_current(FULL_CHAIN),
        **{f"current_{name}_refreshed": _refreshed_current(name) for name in ENTITY_INPUTS},
        "flatten_short_from_refreshed": flatten_short_from_refreshed,
        **{f"history_{name}": _history(name) for name in ATTRIBUTES},
        "timeline_partner": timeline_partner,
        "as_of_accounts": as_of_accounts,
        "intervals_short": intervals_short,
        "stream_current_account": stream_current_account,
        "reconcile_orders": reconcile_orders,
        "flatten_rollup": flatten_rollup,
        "profile_lineitem": profile_lineitem,
        "unit_code_decode": unit_code_decode,
        "unit_code_decode_lenient": unit_code_decode_lenient,
        "stamp_metadata": stamp_metadata,
        "scan_query": scan_query,
        "scan_table": scan_table,
        "scan_path": scan_path,
        "scan_sql_file": scan_sql_file,
        "scan_view": scan_view,
        "scan_explicit_schema": scan_explicit_schema,
        "bound_parameter": bound_parameter,
        "feed_plan_initial": _feed_plan(INITIAL),
        "feed_plan_delta": _feed_plan(DELTA),
        "sink_overwrite": sink_overwrite,
        "sink_initial_dynamic_mode": sink_initial_dynamic_mode,
        "sink_append": sink_append,
        "sink_append_fewer_columns": sink_append_fewer_columns,
        "sink_partitioned": sink_partitioned,
        "sink_partition_replaced": sink_partition_replaced,
        "sink_bucketed": sink_bucketed,
        "sink_clustered_path": sink_clustered_path,
        "sink_curve": sink_curve,
        "curve_range_part": _curve_range("l_partkey", 10, 20),
        "curve_range_supplier": _curve_range("l_suppkey", None, 3),
        "curve_range_date": _curve_range("l_shipdate", "1995-03-01", "1995-04-15"),
        **gate_queries(),
        **migration_queries(),
        "job_run_feed": job_run_feed,
        "job_run_feeds": job_run_feeds,
        "job_run_feeds_text": job_run_feeds_text,
        "job_run_feeds_once": job_run_feeds_once,
        "job_run_declared_feed": job_run_declared_feed,
        "run_feeds_one_fails": run_feeds_one_fails,
        "job_run_flatten": job_run_flatten,
        "job_run_flatten_query_file": job_run_flatten_query_file,
        "feeds_to_flatten": feeds_to_flatten,
    }
