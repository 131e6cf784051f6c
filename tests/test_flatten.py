from datetime import datetime

import pytest
from conftest import jobs_of, plan_of, rows

from stammwerk.functions.unit_codes import FLATTEN_LAYOUT
from stammwerk.operators.flatten import (
    flatten,
    output_names,
    register_current_views,
    staging_to_flatten,
)
from stammwerk.plans.entities import FULL_CHAIN, SHORT_CHAIN

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 2, 1)
# Branch 400, manager 30, department 500, area 20 in the feed layout.
CODE = 203040050000


@pytest.fixture(scope="module")
def inputs(spark):
    make = spark.createDataFrame
    return {
        "info": make(
            [(1, "p1 old", OLD), (1, "p1", NEW), (2, "p2", NEW), (3, "p3", NEW), (4, "p4", NEW)],
            "PARTID int, PARTKLS string, TSAEND timestamp"),
        "natural_person": make(
            [(1, "Dr", NEW), (1, "none", OLD)], "PARTID int, STANG string, TSAEND timestamp"),
        "org_legal_person": make([(2, "2001", OLD)], "PARTID int, GRDGDAT string, TSAEND timestamp"),
        "postal_address": make(
            [(1, "DE", OLD), (1, "AT", NEW), (9, "FR", NEW)],
            "PARTID int, LANDBEZGPOSTADR string, TSAEND timestamp"),
        # Partner 1 has two counterparties, partner 4 none.
        "counterparty": make(
            [(10, 1, NEW), (11, 1, NEW), (20, 2, NEW), (30, 3, OLD), (30, 9, OLD.replace(2023)),
             (40, None, NEW)],
            "counterparty_id int, PARTID int, TSAEND timestamp"),
        # Counterparty 11 has no account; account 20/1 names another partner.
        "account": make(
            [(10, 1, 1, "a", NEW), (10, 1, 1, "a old", OLD), (10, 2, 1, "b", NEW),
             (20, 1, 7, "c", NEW), (30, 1, 3, "d", NEW)],
            "counterparty_id int, sequence_no int, PARTID int, Brand string, TSAEND timestamp"),
        # Account 10/1 has two support rows; the second points to no manager.
        "support": make(
            [(10, 1, 100, CODE, NEW), (10, 1, 100, 0, OLD), (10, 1, 101, 999, NEW),
             (10, 2, 100, None, NEW)],
            "counterparty_id int, sequence_no int, BETREUEINHID int,"
            " acct_mngr_unit_id bigint, TSAEND timestamp"),
        "manager": make(
            [(400, 30, 500, 20, "m", NEW), (400, 30, 500, 20, "m old", OLD), (20, 30, 400, 500, "other", NEW)],
            "branch int, acct_mngr_id int, acct_mngr_dept_id int, acct_mngr_area int,"
            " ERTRAGSTELLE string, TSAEND timestamp"),
    }


SHOWN = ("PARTID", "PARTKLS", "counterparty_counterparty_id", "account_sequence_no", "Brand",
         "BETREUEINHID", "ERTRAGSTELLE")
EXPECTED = [
    (1, "p1", 10, 1, "a", 100, "m"),
    (1, "p1", 10, 1, "a", 101, None),
    (1, "p1", 10, 2, "b", 100, None),
    (1, "p1", 11, None, None, None, None),
    (2, "p2", 20, None, None, None, None),
    (3, "p3", 30, 1, "d", None, None),
    (4, "p4", None, None, None, None, None),
]


@pytest.mark.parametrize("protect", [[], ["account"], ["counterparty", "support", "manager"]])
def test_short_chain(inputs, protect):
    assert rows(flatten(inputs, SHORT_CHAIN, protect=protect), *SHOWN) == EXPECTED


def test_only_joins_of_the_chain_can_be_protected(inputs):
    for name in ("info", "postal_address", "nothing"):
        with pytest.raises(ValueError):
            flatten(inputs, SHORT_CHAIN, protect=[name])


def test_no_job_runs_while_a_plan_is_built(spark, inputs):
    with jobs_of(spark) as jobs:
        flatten(inputs, FULL_CHAIN, protect=["account"]).explain()
    assert jobs() == []


def test_only_keys_dates_and_tie_breaks_are_sorted_by(inputs):
    more = dict(inputs)
    more["info"] = inputs["info"].selectExpr("*", "TSAEND AS SYS_START", "map(1, 2) AS unsortable")
    plan = plan_of(flatten(more, SHORT_CHAIN))
    assert "SYS_START" in plan
    for line in plan.splitlines():
        if "Sort [" in line:
            assert "unsortable" not in line and "PARTKLS" not in line


@pytest.mark.parametrize("protect", [[], ["natural_person", "postal_address"]])
def test_full_chain(inputs, protect):
    wide = flatten(inputs, FULL_CHAIN, protect=protect)
    assert rows(wide, *SHOWN) == EXPECTED
    persons = {tuple(r) for r in wide.select("PARTID", "STANG", "GRDGDAT", "LANDBEZGPOSTADR").collect()}
    assert persons == {(1, "Dr", None, "AT"), (2, None, "2001", None), (3, None, None, None), (4, None, None, None)}


@pytest.mark.parametrize("protect", [[], [e.name for e in FULL_CHAIN[1:]]])
def test_all_versions_multiply(spark, inputs, protect):
    found = flatten(inputs, FULL_CHAIN, all_versions=True, protect=protect)
    for name, df in inputs.items():
        df.createOrReplaceTempView(f"all_{name}")
    expected = spark.sql("""
        SELECT i.PARTID, i.PARTKLS, c.counterparty_id, a.sequence_no, a.Brand, s.BETREUEINHID,
               m.ERTRAGSTELLE
        FROM all_info i
        LEFT JOIN all_natural_person n ON n.PARTID = i.PARTID
        LEFT JOIN all_org_legal_person o ON o.PARTID = i.PARTID
        LEFT JOIN all_postal_address p ON p.PARTID = i.PARTID
        LEFT JOIN all_counterparty c ON c.PARTID = i.PARTID
        LEFT JOIN all_account a ON a.PARTID = i.PARTID AND a.counterparty_id = c.counterparty_id
        LEFT JOIN all_support s ON s.counterparty_id = a.counterparty_id AND s.sequence_no = a.sequence_no
        LEFT JOIN all_manager m ON m.acct_mngr_area = int(substr(lpad(string(s.acct_mngr_unit_id), 13, '0'), 2, 2))
             AND m.acct_mngr_id = int(substr(lpad(string(s.acct_mngr_unit_id), 13, '0'), 4, 2))
             AND m.branch = int(substr(lpad(string(s.acct_mngr_unit_id), 13, '0'), 6, 3))
             AND m.acct_mngr_dept_id = int(substr(lpad(string(s.acct_mngr_unit_id), 13, '0'), 9, 3))
    """)
    assert rows(found, *SHOWN) == rows(expected)


def test_other_code_layout(inputs):
    wide = flatten(inputs, SHORT_CHAIN, layout=FLATTEN_LAYOUT)
    assert (1, 100, "other") in rows(wide, "PARTID", "BETREUEINHID", "ERTRAGSTELLE")


def test_output_names_are_unique_and_prefixed(inputs):
    wide = flatten(inputs, FULL_CHAIN)
    assert len(set(wide.columns)) == len(wide.columns) == sum(len(d.columns) for d in inputs.values())
    names = output_names(inputs, FULL_CHAIN)
    assert names["info"]["PARTID"] == "PARTID"
    assert names["account"]["PARTID"] == "account_PARTID"
    assert names["info"]["TSAEND"] == "info_TSAEND"


def test_current_views(spark, inputs):
    views = register_current_views(inputs, {})
    assert len(views) == 8
    assert rows(spark.table("v_partner_info_current"), "PARTKLS") == [("p1",), ("p2",), ("p3",), ("p4",)]
    assert spark.table("v_partner_acct_manager_current").count() == 2


def test_staging_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "GESCHPARTID int, IDLFDNR int, BETREU int")
    assert staging_to_flatten(df).columns == ["counterparty_id", "sequence_no", "acct_mngr_unit_id"]


@pytest.mark.parametrize("all_versions", [False, True])
@pytest.mark.parametrize("protect", [[], ["account"], ["support"], ["counterparty", "manager"]])
def test_gathering_changes_no_row(inputs, protect, all_versions):
    expected = flatten(inputs, FULL_CHAIN, all_versions=all_versions)
    found = flatten(inputs, FULL_CHAIN, all_versions=all_versions, protect=protect, gathered=True, managers_first=True)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_what_hangs_on_accounts_is_not_shuffled_again(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")
    try:
        plain, gathered = (plan_of(flatten(inputs, SHORT_CHAIN, gathered=g)) for g in (False, True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    assert "account_PARTID" in "".join(l for l in plain.splitlines() if "Exchange hash" in l)
    assert "account_PARTID" not in "".join(l for l in gathered.splitlines() if "Exchange hash" in l)
