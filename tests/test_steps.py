import os
import random
import time
from datetime import datetime

import pytest
from conftest import SF_DIR, plan_of, rows

from checks import queries
from stammwerk.functions.unit_codes import FEED_LAYOUT, FLATTEN_LAYOUT, decode_number, decode_unit
from stammwerk.operators.flatten import flatten
from stammwerk.operators.flatten_history import flatten_intervals
from stammwerk.operators.joins import Steps, left_join
from stammwerk.plans.entities import FULL_CHAIN, SHORT_CHAIN
from stammwerk.session import CLEANUP_SETTING, stored

EVERY = [e.name for e in FULL_CHAIN[1:]]


@pytest.fixture(scope="module")
def inputs(spark):
    """Few keys, some null, met by rows of several versions, and codes of all kinds."""
    rng = random.Random(4)
    ids = [None, *range(7)]

    def make(n, schema, *values):
        made = [tuple(f"t{i}" if v == "text" else i if v == "row" else rng.choice(v) for v in values) for i in range(n)]
        return spark.createDataFrame(made, schema)

    codes = [None, 203040050000, 10100200300, 0, 77, 9_203_040_050_000, 92_030_400_500_001]
    times = [None, 1, 2, 3]
    return {
        "info": make(20, "PARTID long, PARTKLS string, TSAEND int, r int", ids, "text", times, "row"),
        "natural_person": make(9, "PARTID long, STANG string, TSAEND int, r int", ids, "text", times, "row"),
        "org_legal_person": make(4, "PARTID int, GRDGDAT string, TSAEND int, r int", ids, "text", times, "row"),
        "postal_address": make(5, "PARTID long, LANDBEZGPOSTADR string, TSAEND int, r int", ids, "text", times, "row"),
        "counterparty": make(16, "counterparty_id long, PARTID long, TSAEND int, r int", ids, ids, times, "row"),
        # The sequence of accounts has another type than that of support rows.
        "account": make(30, "counterparty_id long, sequence_no long, PARTID long, Brand string, TSAEND int, r int",
                        ids, [None, 0, 1], ids, "text", times, "row"),
        "support": make(30, "counterparty_id long, sequence_no int, BETREUEINHID int, acct_mngr_unit_id bigint,"
                        " TSAEND int, r int", ids, [None, 0, 1], range(3), codes, times, "row"),
        "manager": make(12, "branch int, acct_mngr_id int, acct_mngr_dept_id int, acct_mngr_area int,"
                        " ERTRAGSTELLE string, TSAEND int, r int", [400, 2], [30, 10], [500, 3], [20, 1], "text", times, "row"),
    }


@pytest.mark.parametrize("protect, gathered, all_versions", [
    ([], True, True), (EVERY, True, True), (["account"], True, False), ([], False, False),
])
def test_steps_change_no_row(inputs, protect, gathered, all_versions):
    ties = {n: ("r",) for n in inputs}
    expected = flatten(inputs, FULL_CHAIN, ties, all_versions=all_versions)
    found = flatten(inputs, FULL_CHAIN, ties, all_versions=all_versions, protect=protect, gathered=gathered, staged=True)
    assert found.dtypes == expected.dtypes
    assert rows(found) == rows(expected)


def test_steps_of_the_short_chain(inputs):
    protect = [e.name for e in SHORT_CHAIN[1:]]
    expected = rows(flatten(inputs, SHORT_CHAIN))
    assert rows(flatten(inputs, SHORT_CHAIN, protect=protect, staged=True)) == expected


@pytest.mark.parametrize("protect", [False, True])
def test_columns_that_a_join_makes_equal_are_left_out(spark, protect):
    left = spark.createDataFrame([(1, 0.0, "a"), (2, 1.0, "b"), (None, 1.0, "c")], "a int, d double, l string")
    right = spark.createDataFrame([(1, -0.0, "x"), (1, 0.0, "y"), (3, 1.0, "z")], "ra int, rd double, r string")
    on = [("a", "ra"), ("d", "rd")]
    steps = Steps()
    joined = steps.left_join(left, right, on, "met", protect)
    # A zero may be signed, so only the whole number follows from the left side.
    assert sorted(joined.columns) == ["a", "d", "l", "met", "r", "rd"]
    shown = joined.select([steps.shown(c) for c in ("a", "d", "l", "ra", "rd", "r")])
    assert sorted(map(str, shown.collect())) == sorted(map(str, left_join(left, right, on).collect()))


@pytest.mark.parametrize("layout", [FEED_LAYOUT, FLATTEN_LAYOUT])
def test_codes_are_decoded_alike_by_division(spark, layout):
    codes = [None, 0, 5, 203040050069, 9_999_999_999_999, 10_000_000_000_000, 92_030_400_500_001, 2**62]
    df = spark.createDataFrame([(c,) for c in codes], "code long")
    by_text, by_number = decode_unit(df.code, layout), decode_number("code", layout)
    assert rows(df.select(*by_number.values())) == rows(df.select(*by_text.values()))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files) if f.getName().startswith("shuffle_")}


def test_what_is_stored_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = spark.range(5000).repartition(7, "id")
    kept = stored(df, "x")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert kept.count() == 5000
    assert spark.conf.get(CLEANUP_SETTING) == "false"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_feeds_are_flattened_from_stored_current_rows(spark):
    assert "Window" not in plan_of(queries.feeds_to_flatten(spark, SF_DIR))


def test_all_but_the_last_interval_join_are_stored(inputs):
    ties = {n: ("r",) for n in inputs}
    plan = plan_of(flatten_intervals(inputs, SHORT_CHAIN, ties, parts=3))
    assert plan.count("Join") <= 1, plan


def test_all_versions_of_managers_are_aligned(spark, tmp_path):
    days = [datetime(2000, 1, d) for d in (1, 5, 9)]
    tables = {
        "supplier": ([(7, "s")], "s_suppkey long, s_name string"),
        "orders": ([(1, 2, "F", days[0], "low")], "o_orderkey long, o_custkey long, o_orderstatus string,"
                   " o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(1, i, 7, i, 1.0, day) for i, day in enumerate(days, 1)], "l_orderkey long, l_partkey long,"
                     " l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz"),
    }
    for name, (made, schema) in tables.items():
        spark.createDataFrame(made, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = queries.intervals_short(spark, str(tmp_path)).where("account_sequence_no = 1 AND manager_TSAEND IS NOT NULL")
    assert rows(found, "manager_TSAEND") == [(day,) for day in days]
