import json

import pytest
from test_extract import tables

from stammwerk.operators.extract import extract
from stammwerk.functions.load_metadata import load_metadata, stamp
from conftest import plan_of, rows
from stammwerk.operators.flatten import flatten, read_entities
from stammwerk.plans.entities import SHORT_CHAIN
from stammwerk.plans.feeds import NINE_FEEDS
from stammwerk.plans.jobs import (
    gated_load,
    run_feed,
    run_feeds,
    run_flatten,
    status_frame,
    write_current_tables,
)
from stammwerk.sinks.writers import create_target
from stammwerk.sources.feed_config import FeedPlan
from test_flatten import inputs  # noqa: F401



def meta():
    return load_metadata("2024-06-30", "s", "u")



@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The nine feeds over vault tables, each with a target, and their configuration."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS raw")
    spark.sql("CREATE SCHEMA IF NOT EXISTS stage")
    entities = {}
    for name, feed in NINE_FEEDS.items():
        hub, satellite = tables(spark, feed)
        hub.write.mode("overwrite").saveAsTable(f"raw.{feed.hub}")
        satellite.write.mode("overwrite").saveAsTable(f"raw.{feed.satellite}")
        rows = stamp(extract(feed, hub, satellite), meta())
        create_target(spark, f"stage.{name}", rows.schema, ["md_book_date"],
                      [feed.hub_columns[0], "md_book_date"], buckets=2)
        entities[name] = {
            "target_dataset": "stage", "target_tableName": name,
            "partition_enabled": "Yes", "partition_columns": ["md_book_date"],
            "cluster_enabled": "Yes", "cluster_columns": [feed.hub_columns[0], "md_book_date"],
            "static_metadata_fields": ["md_book_date", "md_load_date", "md_load_user", "md_source_system"],
        }
    # One feed names a target that does not exist.
    entities["Partner_Industry"]["target_tableName"] = "absent"
    path = tmp_path_factory.mktemp("config") / "feeds.json"
    path.write_text(json.dumps({
        "process_Info": {"process_descr": "daily", "source_system": "vault", "tenant_process": "x", "version": "1"},
        "feedEntities": entities,
    }))
    yield str(path)
    for schema in ("raw", "stage"):
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


def test_all_feeds_initial_then_delta(spark, staged):
    statuses = run_feeds(spark, staged, "2024-06-29", "me", "initial", source_schema="raw",
              type_mode="wide", buckets=2)
    assert [s.job.removeprefix("daily_vault_") for s in statuses] == list(NINE_FEEDS)
    assert [s.written for s in statuses] == [True] * 8 + [False]
    assert statuses[-1].failed_checks == ["target_exists"]
    assert not spark.catalog.tableExists("stage.absent")
    info = spark.table("stage.Partner_Info")
    assert info.count() == 5
    run_feeds(spark, staged, "2024-06-30", "me", "delta", "2024-03-01", source_schema="raw",
              type_mode="wide", buckets=2)
    spark.catalog.refreshTable("stage.Partner_Info")
    counts = {str(r.md_book_date): r["count"] for r in
              spark.table("stage.Partner_Info").groupBy("md_book_date").count().collect()}
    assert counts == {"2024-06-29": 5, "2024-06-30": 5}
    assert {r.md_source_system for r in spark.table("stage.Partner_Info").collect()} == {"vault"}
    frame = status_frame(spark, statuses)
    assert frame.where("NOT written").count() == 1


def test_strict_types_reject_a_bigint(spark, staged):
    statuses = run_feeds(spark, staged, "2024-06-29", "me", "initial", source_schema="raw", buckets=2)
    assert [s.failed_checks for s in statuses if not s.written] == [["type:BETREU"], ["target_exists"]]


def test_flatten_job(spark, inputs, tmp_path):  # noqa: F811
    schema = stamp(flatten(inputs, SHORT_CHAIN), meta()).schema
    create_target(spark, "default.wide", schema, ["md_book_date"])

    def run(**options):
        status = run_flatten(spark, "default.wide", "2024-06-30", "me", inputs, type_mode="wide", **options)
        spark.catalog.refreshTable("default.wide")
        return status.written, spark.table("wide").count()

    assert run() == (True, 7)
    assert run() == (True, 14)  # a rerun of an append doubles the rows
    assert run(replace_book_date=True) == (True, 7)
    assert {r.md_source_system for r in spark.table("wide").collect()} == {"partnerdata"}


def test_flatten_job_with_a_query_file_and_with_tables(spark, inputs, tmp_path):  # noqa: F811
    spark.sql("CREATE SCHEMA IF NOT EXISTS flat_in")
    from stammwerk.plans.entities import ENTITIES

    for name, df in inputs.items():
        df.write.mode("overwrite").saveAsTable(f"flat_in.{ENTITIES[name].table}")
    wide = flatten(inputs, SHORT_CHAIN)
    create_target(spark, "default.from_tables", stamp(wide, meta()).schema, ["md_book_date"])
    status = run_flatten(spark, "default.from_tables", "2024-06-30", "me", source_schema="flat_in", type_mode="wide")
    assert status.written and spark.table("from_tables").count() == 7

    (tmp_path / "q.sql").write_text("SELECT PARTID, PARTKLS FROM flat_in.partner_info")
    create_target(spark, "default.from_query",
                  stamp(spark.createDataFrame([], "PARTID int, PARTKLS string"), meta()).schema, ["md_book_date"])
    status = run_flatten(spark, "default.from_query", "2024-06-30", "me", query_path=str(tmp_path / "q.sql"))
    assert status.written and spark.table("from_query").count() == 5


def test_a_misfit_leaves_the_target_untouched(spark):
    good = spark.createDataFrame([(1,)], "a int")
    create_target(spark, "default.kept", good.schema)
    assert gated_load(good, "default.kept", "initial").written
    bad = gated_load(spark.createDataFrame([("x",)], "a string"), "default.kept", "initial")
    assert not bad.written and bad.failed_checks == ["type:a"]
    assert spark.table("kept").collect() == [(1,)]


def test_current_tables_are_bucketed_by_key(spark, inputs):  # noqa: F811
    spark.sql("CREATE SCHEMA IF NOT EXISTS current")
    for _ in range(2):
        written = write_current_tables(spark, "current", inputs, {}, buckets=2)
    assert len(written) == 8
    assert spark.table("current.v_partner_info_current").count() == 4
    buckets = {c.name for c in spark.catalog.listColumns("current.v_partner_filalkunde_current") if c.isBucket}
    assert buckets == {"counterparty_id"}


def test_flatten_from_current_tables_ranks_nothing(spark, inputs):  # noqa: F811
    spark.sql("CREATE SCHEMA IF NOT EXISTS held")
    write_current_tables(spark, "held", inputs, buckets=4)
    expected = flatten(inputs, SHORT_CHAIN)
    create_target(spark, "default.from_current", stamp(expected, meta()).schema, ["md_book_date"])
    status = run_flatten(spark, "default.from_current", "2024-06-30", "me", source_schema="held",
                         from_current=True, type_mode="wide")
    assert status.written
    assert rows(spark.table("from_current"), *expected.columns) == rows(expected)
    plan = plan_of(flatten(read_entities(spark, SHORT_CHAIN, "held", current=True), SHORT_CHAIN,
                           from_current=True))
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") <= 2


def plan(**values):
    stated = {"feed": "Partner_Info", "job": "j", "process": "p", "tenant_process": "t", "source_system": "s",
              "load_type": "delta", "changed_since": None, "query": "SELECT 1 AS a", "target": "default.x",
              "partition_columns": (), "cluster_columns": (), "metadata_fields": ()}
    return FeedPlan(**stated | values)


def test_a_delta_needs_its_date(spark):
    for queries in ("spec", "text"):
        with pytest.raises(ValueError, match="changed_since"):
            run_feed(spark, plan(), "2024-06-30", "me", queries=queries)


def test_where_rows_come_from(spark):
    with pytest.raises(ValueError, match="queries"):
        run_feed(spark, plan(), "2024-06-30", "me", queries="both")
    with pytest.raises(ValueError, match="no known feed"):
        run_feed(spark, plan(feed="Other", query=None, load_type="initial"), "2024-06-30", "me")
    # An unknown feed runs its text, a known one only on request.
    other = run_feed(spark, plan(feed="Other", load_type="initial"), "2024-06-30", "me")
    text = run_feed(spark, plan(load_type="initial"), "2024-06-30", "me", queries="text")
    assert other.failed_checks == text.failed_checks == ["target_exists"]


def test_a_failing_feed_keeps_the_others_statuses(spark, staged, tmp_path):
    with open(staged) as file:
        config = json.load(file)
    config["feedEntities"]["Odd"] = config["feedEntities"]["Partner_Info"] | {
        "initial_query": "SELECT * FROM nowhere"}
    path = tmp_path / "odd.json"
    path.write_text(json.dumps(config))
    options = dict(source_schema="raw", type_mode="wide", buckets=2)
    statuses = run_feeds(spark, str(path), "2024-06-29", "me", "initial", **options)
    assert [s.written for s in statuses] == [True] * 8 + [False, False]
    assert "nowhere" in statuses[-1].error and statuses[0].error is None
    assert status_frame(spark, statuses).where("error IS NOT NULL").count() == 1
    with pytest.raises(Exception, match="nowhere"):
        run_feeds(spark, str(path), "2024-06-29", "me", "initial", raise_errors=True, **options)
