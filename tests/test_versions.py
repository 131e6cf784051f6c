from datetime import datetime

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stammwerk.operators.versions import current_rows, pick_version, version_order

D = [None] + [datetime(2024, 1, d) for d in range(1, 10)]
SCHEMA = "k int, TSAEND timestamp, SYS_START int, SYS_END int, v string"


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame(
        [
            (1, D[1], 1, 5, "old"),
            (1, D[2], 1, 5, "middle"),
            (1, D[3], 1, 5, "new"),
            (2, D[1], 1, 5, "ends early"),
            (2, D[1], 1, 9, "ends late"),
            (2, D[1], 2, 9, "starts late"),
            (3, None, 1, 5, "undated"),
            (3, D[4], 1, 5, "dated"),
            (None, D[1], 1, 1, "no key"),
            (None, D[2], 1, 1, "no key, newer"),
        ],
        SCHEMA,
    )


def test_as_written_takes_the_oldest_change_and_the_latest_end(versions):
    order = version_order(["TSAEND", "SYS_START", "SYS_END"], "as_written")
    assert rows(pick_version(versions, ["k"], order), "k", "v") == [
        (None, "no key"),
        (1, "old"),
        (2, "ends late"),
        (3, "undated"),
    ]


def test_latest_takes_the_newest_in_every_column(versions):
    order = version_order(["TSAEND", "SYS_START", "SYS_END"], "latest")
    assert rows(pick_version(versions, ["k"], order), "k", "v") == [
        (None, "no key, newer"),
        (1, "new"),
        (2, "starts late"),
        (3, "dated"),
    ]


def test_unknown_order_is_refused():
    with pytest.raises(ValueError):
        version_order(["a"], "newest")


def test_current_rows_uses_the_stated_tie_break(versions):
    found = current_rows(versions, ["k"], ["SYS_START", "SYS_END"])
    assert (2, "starts late") in rows(found, "k", "v")
    assert found.columns == versions.columns


def test_current_rows_without_tie_break_does_not_depend_on_row_order(spark):
    data = [(k, D[1], s, e, f"v{s}{e}") for k in range(20) for s in range(3) for e in range(3)]
    expected = None
    for seed in range(3):
        shuffled = spark.createDataFrame(data, SCHEMA).orderBy(F.rand(seed)).repartition(4)
        found = rows(current_rows(shuffled, ["k"]))
        expected = expected or found
        assert found == expected
    assert len(expected) == 20


def test_composite_key(spark):
    df = spark.createDataFrame(
        [(1, 1, D[1], "a"), (1, 2, D[1], "b"), (1, 2, D[2], "c")],
        "k int, n int, TSAEND timestamp, v string",
    )
    assert rows(current_rows(df, ["k", "n"], ()), "v") == [("a",), ("c",)]


def test_hot_keys_are_reduced_before_the_shuffle(versions):
    plan = plan_of(current_rows(versions, ["k"], ["SYS_START"]))
    final, shuffle, partial = (
        plan.index("1, Final"),
        plan.index("Exchange hashpartitioning"),
        plan.index("1, Partial"),
    )
    assert final < shuffle < partial


def test_bucketed_table_needs_no_shuffle(spark, versions):
    versions.write.bucketBy(4, "k").sortBy("k", "TSAEND").mode("overwrite").saveAsTable("bucketed_versions")
    plan = plan_of(current_rows(spark.table("bucketed_versions"), ["k"], ["SYS_START"]))
    assert "Exchange" not in plan


def test_picked_versions_may_be_gathered_by_some_of_the_keys(spark):
    data = [(a, b, t, len(str(t)) + (t or 0)) for a in (None, 1, 2) for b in (None, 1, 2, 3) for t in (None, 1, 2, 2, 5)]
    versions = spark.createDataFrame(data, "a int, b int, TSAEND int, tie int")
    expected = current_rows(versions, ["a", "b"], ["tie"])
    gathered = current_rows(versions, ["a", "b"], ["tie"], gather_by=["a"])
    assert rows(gathered) == rows(expected) and gathered.count() == 12
    exchanges = [line for line in plan_of(gathered).splitlines() if "Exchange" in line]
    assert exchanges and all("hashpartitioning(a#" in e and "b#" not in e for e in exchanges)
