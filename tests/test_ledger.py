import pytest
from conftest import rows
from test_jobs import staged  # noqa: F401

from stammwerk.plans import ledger as module
from stammwerk.plans.ledger import read_ledger, run_feeds_once

NAMES = ["Partner_Info", "Partner_Counterparty", "Partner_Cust_Support"]
STABLE = ["TSAEND", "MD_HDIFF_ATTRIBUTES", "md_book_date"]


@pytest.fixture
def config(spark, staged, tmp_path):  # noqa: F811
    """Feeds whose targets all exist and are empty, and a ledger of their own."""
    import json

    with open(staged, encoding="utf-8") as file:
        document = json.load(file)
    document["feedEntities"] = {n: document["feedEntities"][n] for n in NAMES}
    for name in NAMES:
        spark.sql(f"TRUNCATE TABLE stage.{name}")
    path = tmp_path / "feeds.json"
    path.write_text(json.dumps(document))
    yield str(path), "stage.ledger"
    spark.sql("DROP TABLE IF EXISTS stage.ledger")


def run(spark, config, book_date="2024-06-29", load_type="initial", since=None):
    return run_feeds_once(spark, config[0], book_date, "me", config[1], load_type, since,
                          source_schema="raw", type_mode="wide", buckets=2)


def tables(spark):
    found = {}
    for name in NAMES:
        spark.catalog.refreshTable(f"stage.{name}")
        found[name] = rows(spark.table(f"stage.{name}"), *STABLE)
    return found


def test_repeated_runs_leave_each_book_date_once(spark, config):
    first = run(spark, config)
    assert [s.written for s in first] == [True] * 3
    once = tables(spark)
    assert all(once.values())
    assert [s.written for s in run(spark, config)] == [False] * 3
    assert tables(spark) == once
    for _ in range(3):
        run(spark, config, "2024-06-30", "delta", "2024-03-01")
    twice = tables(spark)
    assert all(len(twice[n]) > len(once[n]) for n in NAMES)
    assert all(len(set(map(str, t))) == len(t) for t in twice.values())
    steps = [r.step for r in read_ledger(spark, config[1]).collect()]
    assert (steps.count("staged"), steps.count("loaded"), steps.count("done")) == (6, 6, 2)


@pytest.mark.parametrize("survive", [0, 2])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_that_dies_is_carried_through(spark, config, monkeypatch, survive, when):
    run(spark, config)
    run(spark, config, "2024-06-30", "delta", "2024-03-01")
    whole = tables(spark)
    for name in NAMES:
        spark.sql(f"TRUNCATE TABLE stage.{name}")
    spark.sql(f"DROP TABLE {config[1]}")

    run(spark, config)
    real, calls = module._publish, []

    def publish(spark, entry, buckets):
        calls.append(entry.job)
        if len(calls) > survive:
            if when == "after":  # the rows are there but no entry says so
                real(spark, entry, buckets)
            raise RuntimeError("killed")
        real(spark, entry, buckets)

    with monkeypatch.context() as patch:
        patch.setattr(module, "_publish", publish)
        with pytest.raises(RuntimeError):
            run(spark, config, "2024-06-30", "delta", "2024-03-01")
    # The sources change in the meantime; the run goes on with what it has staged.
    monkeypatch.setattr(module, "feed_rows", None)
    run(spark, config, "2024-06-30", "delta", "2024-03-01")
    assert tables(spark) == whole


def test_dying_while_rows_are_staged_touches_no_target(spark, config, monkeypatch):
    before = tables(spark)

    def die(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(module, "_enter", die)
        with pytest.raises(KeyboardInterrupt):
            run(spark, config)
    assert tables(spark) == before and read_ledger(spark, config[1]).count() == 0
    assert all(s.written for s in run(spark, config))


def test_all_targets_or_none(spark, staged, config):  # noqa: F811
    before = tables(spark)
    statuses = run_feeds_once(spark, staged, "2024-06-29", "me", config[1], "initial",
                              source_schema="raw", type_mode="wide")
    assert [s.failed_checks for s in statuses if s.failed_checks] == [["target_exists"]]
    assert not any(s.written for s in statuses) and tables(spark) == before


def test_one_load_type_per_book_date_and_one_partition_column(spark, config):
    run(spark, config)
    with pytest.raises(ValueError, match="has loaded"):
        run(spark, config, "2024-06-29", "delta", "2024-03-01")
    spark.sql("ALTER TABLE stage.Partner_Info RENAME TO stage.info_kept")
    try:
        spark.table("stage.info_kept").limit(0).write.saveAsTable("stage.Partner_Info")
        statuses = run(spark, config, "2024-06-30", "delta", "2024-03-01")
        assert statuses[0].failed_checks == ["one_book_date"]
    finally:
        spark.sql("DROP TABLE stage.Partner_Info")
        spark.sql("ALTER TABLE stage.info_kept RENAME TO stage.Partner_Info")
