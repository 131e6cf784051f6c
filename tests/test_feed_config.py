import json

import pytest

from stammwerk.plans.feeds import FeedSpec
from stammwerk.sources.feed_config import expand_feeds, feed_plans, read_feed_config

ENTITY = {
    "type": "x", "initial_query": "SELECT 1 AS i", "delta_query": "SELECT 2 AS d",
    "target_dataset": "stage", "target_tableName": "t",
    "static_metadata_fields": ["book_date", "load_type"],
}
LAYOUT = {
    "partition_enabled": "yes", "partition_columns": ["md_book_date"],
    "cluster_enabled": "YES", "cluster_columns": ["PARTID", "md_book_date"],
}


def config(spark, tmp_path, entities, strategy=None, drop=()):
    document = {
        "process_Info": {"process_descr": "daily", "source_system": "vault",
                         "tenant_process": "stage", "version": "1"},
        "feedEntities": entities,
    }
    if strategy:
        document["loadStrategy"] = strategy
    for key in drop:
        del document[key]
    path = tmp_path / "config.json"
    path.write_text(json.dumps(document, indent=1))
    return read_feed_config(spark, str(path))


def test_feeds_in_document_order(spark, tmp_path):
    names = [f"Feed_{c}" for c in "zaymbx"]
    feeds = expand_feeds(config(spark, tmp_path, dict.fromkeys(names, ENTITY)), "initial")
    plans = feed_plans(feeds)
    assert [p.feed for p in plans] == names
    assert plans[0].job == "daily_vault_Feed_z"
    assert plans[0].target == "stage.t"
    assert plans[0].metadata_fields == ("book_date", "load_type")
    assert {(p.process, p.source_system, p.tenant_process) for p in plans} == {("daily", "vault", "stage")}


def test_load_type_chooses_the_query(spark, tmp_path):
    frame = config(spark, tmp_path, {"F": ENTITY})
    assert feed_plans(expand_feeds(frame, "initial"))[0].query == "SELECT 1 AS i"
    delta = feed_plans(expand_feeds(frame, "delta", "2024-01-01"))[0]
    assert (delta.query, delta.changed_since) == ("SELECT 2 AS d", "2024-01-01")
    with pytest.raises(ValueError):
        expand_feeds(frame, "full")
    with pytest.raises(ValueError):
        feed_plans(expand_feeds(frame))


def test_layout_flags_are_honoured(spark, tmp_path):
    entities = {
        "on": ENTITY | LAYOUT,
        "off": ENTITY | LAYOUT | {"partition_enabled": "No", "cluster_enabled": "No"},
        "unset": ENTITY | {"partition_columns": ["a"], "cluster_columns": ["b"]},
    }
    plans = feed_plans(expand_feeds(config(spark, tmp_path, entities), "initial"))
    assert [(p.partition_columns, p.cluster_columns) for p in plans] == [
        (("md_book_date",), ("PARTID", "md_book_date")), ((), ()), ((), ())]


def test_load_strategy_gives_defaults(spark, tmp_path):
    strategy = {"load": "Yes", "load_type": "initial",
                "partition": {"enabled": "Yes", "partition_by": "md_book_date"}}
    frame = config(spark, tmp_path, {"F": ENTITY, "off": ENTITY | {"partition_enabled": "No"}}, strategy)
    plans = feed_plans(expand_feeds(frame))
    assert [p.load_type for p in plans] == ["initial", "initial"]
    assert [p.partition_columns for p in plans] == [("md_book_date",), ()]
    assert feed_plans(expand_feeds(frame, "delta", "2024-01-01"))[0].load_type == "delta"


def test_a_strategy_can_switch_loading_off(spark, tmp_path):
    frame = config(spark, tmp_path, {"F": ENTITY}, {"load": "No", "load_type": "initial"})
    assert feed_plans(expand_feeds(frame)) == []


def test_placeholders_in_the_strategy(spark, tmp_path):
    strategy = {"load": "Yes", "load_type": "{{load_type}}",
                "partition": {"enabled": "Yes", "partition_by": "{{book_date}}"}}
    plan = feed_plans(expand_feeds(config(spark, tmp_path, {"F": ENTITY}, strategy), "delta", "2024-01-01"))[0]
    assert (plan.load_type, plan.partition_columns) == ("delta", ("md_book_date",))


def test_broken_documents_raise(spark, tmp_path):
    with pytest.raises(ValueError):
        config(spark, tmp_path, {"F": ENTITY}, drop=["process_Info"])
    (tmp_path / "bad.json").write_text('{"process_Info": {')
    with pytest.raises(Exception):
        read_feed_config(spark, str(tmp_path / "bad.json"))
    with pytest.raises(Exception):
        read_feed_config(spark, str(tmp_path / "absent.json"))


SPEC = {
    "hub": "things_h", "satellite": "things_s", "key": "HK", "hub_columns": ["ID"],
    "satellite_columns": ["NAME"], "equals": {"KIND": "1"},
}


def test_a_feed_declared_by_its_fields(spark, tmp_path):
    entities = {"Things": ENTITY | {"spec": SPEC}, "F": ENTITY}
    declared, plain = feed_plans(expand_feeds(config(spark, tmp_path, entities), "initial"))
    assert plain.spec is None
    assert declared.spec == FeedSpec("Things", "things_h", "things_s", "HK", ("ID",), ("NAME",), {"KIND": "1"})
    whole = SPEC | {"version_columns": ["A", "B", "C"], "tie_break": "D", "hub_is_unique": True,
                    "unit_code": "U", "unit_names": {"area": "X"}}
    (found,) = feed_plans(expand_feeds(config(spark, tmp_path, {"Things": ENTITY | {"spec": whole}}), "initial"))
    assert found.spec.version_columns == ("A", "B", "C") and found.spec.hub_is_unique and found.spec.unit_names == {"area": "X"}
    with pytest.raises(ValueError, match="lacks"):
        feed_plans(expand_feeds(config(spark, tmp_path, {"Things": ENTITY | {"spec": {"hub": "h"}}}), "initial"))
