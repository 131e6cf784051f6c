import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stammwerk.operators.extract import extract
from stammwerk.plans import changes, current_store
from stammwerk.plans.changes import FeedStore, delivered, extracted, last_run, new_versions, take_changes
from stammwerk.plans.feeds import FeedSpec

FEED = FeedSpec("Things", "h", "s", "HK", ("ID",), ("A", "B"), equals={"B": 2})
TYPES = "HK string, A string, B int, TSAEND timestamp, SYS_START int, SYS_END int, MD_HDIFF_ATTRIBUTES string"


@pytest.fixture
def schema(spark, request):
    name = f"changes_{abs(hash(request.node.name)) % 10**8}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def satellite(spark, found):
    return spark.createDataFrame(
        [(k, a, b, t, s, e, f"{a}") for k, a, b, t, s, e in found], TYPES.replace("TSAEND timestamp", "TSAEND long")
    ).withColumn("TSAEND", F.timestamp_seconds("TSAEND"))


def hub(spark, keys):
    return spark.createDataFrame([(f"k{k}", k) for k in keys], "HK string, ID int")


def test_runs_equal_full_extracts(spark, schema):
    rng = random.Random(3)

    def some(n):
        return [(rng.choice([None, *[f"k{i}" for i in range(30)]]), rng.choice("xyz"), rng.choice([1, 2, 2, 2]),
                 rng.choice([None, *range(50)]), rng.choice([None, 1, 2]), rng.randint(0, 3)) for _ in range(n)]

    held, keys = [], range(0, 20)
    for more in (some(60), some(40), [], some(40)):
        held += more + held[: len(held) // 3]  # some are delivered again
        keys = range(0, len(keys) + 4)  # hub rows come later than some of their versions
        take_changes(FEED, hub(spark, keys), satellite(spark, held), schema, buckets=4)
        full = extract(FEED, hub(spark, keys), satellite(spark, held), "initial", order="latest")
        assert rows(extracted(spark, FEED, schema)) == rows(full)
        # What was delivered last of each key holds the attributes of the full extract.
        last = {r.ID: r for r in sorted(delivered(spark, FEED, schema).collect(), key=lambda r: r._run)}
        assert {(r.ID, r.A) for r in last.values()} == {(r.ID, r.A) for r in full.collect()}


def test_late_unchanged_and_repeated_versions(spark, schema):
    first = [("k1", "x", 2, 10, 1, 0), ("k2", "x", 2, 20, 1, 0), ("k3", "x", 2, 5, 1, 0), ("k4", "x", 2, 5, 1, 0)]
    take_changes(FEED, hub(spark, range(9)), satellite(spark, first), schema, buckets=4)
    later = [
        *first,  # repeated
        ("k1", "x", 2, 30, 1, 0),  # newer, attributes unchanged
        ("k2", "y", 2, 15, 1, 0),  # late and older than the stored version
        ("k3", "y", 2, 7, 1, 0),  # late by the mark, newer for its key
        ("k5", "z", 2, 3, 1, 0),  # late, a new key
        ("k4", "y", 1, 40, 1, 0),  # does not fit the filter
        ("k99", "y", 2, 41, 1, 0),  # no hub row yet
    ]
    run = take_changes(FEED, hub(spark, range(9)), satellite(spark, later), schema)
    assert run == 2
    assert sorted((r.ID, r.A) for r in delivered(spark, FEED, schema, after_run=1).collect()) == [(3, "y"), (5, "z")]
    assert last_run(spark, FeedStore(schema, FEED.name))[1].startswith("1970-01-01 00:00:30")
    take_changes(FEED, hub(spark, [*range(9), 99]), satellite(spark, later), schema)
    assert [(r.ID, r.A) for r in delivered(spark, FEED, schema, after_run=2).collect()] == [(99, "y")]
    take_changes(FEED, hub(spark, [*range(9), 99]), satellite(spark, later), schema)
    assert delivered(spark, FEED, schema, after_run=3).count() == 0


@pytest.mark.parametrize("dies", ["refresh_current", "_in_run", "publish"])
def test_a_dead_run_is_taken_up_again(spark, schema, monkeypatch, dies):
    first = [(f"k{i}", "x", 2, i, 1, 0) for i in range(20)]
    take_changes(FEED, hub(spark, range(30)), satellite(spark, first), schema, buckets=4)
    later = first + [(f"k{i}", "y", 2, 50 + i, 1, 0) for i in range(0, 20, 3)] + [("k25", "y", 2, 1, 1, 0)]

    def die(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if dies == "publish":
            patch.setattr(current_store, "_publish", die)
        elif dies == "_in_run":
            real, calls = changes._in_run, []
            patch.setattr(changes, "_in_run", lambda *a: die() if calls else calls.append(1) or real(*a))
        else:
            patch.setattr(changes, dies, die)
        with pytest.raises(RuntimeError):
            take_changes(FEED, hub(spark, range(30)), satellite(spark, later), schema)
    assert last_run(spark, FeedStore(schema, FEED.name))[0] == 1
    assert delivered(spark, FEED, schema, after_run=1).count() == 0
    assert take_changes(FEED, hub(spark, range(30)), satellite(spark, later), schema) == 2
    assert delivered(spark, FEED, schema, after_run=1).count() == 8
    assert rows(extracted(spark, FEED, schema)) == rows(
        extract(FEED, hub(spark, range(30)), satellite(spark, later), "initial", order="latest"))


def test_empty_satellites_and_the_plan(spark, schema):
    none = satellite(spark, [])
    take_changes(FEED, hub(spark, range(5)), none, schema, buckets=4)
    assert extracted(spark, FEED, schema).count() == 0
    take_changes(FEED, hub(spark, range(5)), satellite(spark, [("k1", "x", 2, 4, 1, 0)]), schema)
    assert extracted(spark, FEED, schema).count() == 1
    plan = plan_of(new_versions(FEED, satellite(spark, [("k1", "x", 2, 4, 1, 0)]), FeedStore(schema, FEED.name)))
    assert "LeftAnti" in plan and "NestedLoop" not in plan
