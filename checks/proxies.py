"""The driver's tables dressed as vault tables and flatten inputs.

Each text is a plain projection (with a join where a column comes from another
table) that Spark and DuckDB both run; ``{name}`` stands for a driver table. The
operators under test are never part of these texts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from stammwerk.plans.feeds import NINE_FEEDS

# Packed unit code of a supplier: area, manager, branch, department; 12 digits at most.
UNIT_CODE = (
    "({k} % 25) * 10000000000 + ({k} % 97) * 100000000"
    " + ({k} % 1000) * 100000 + (({k} * 7) % 1000) * 100"
)
LINE_CODE = UNIT_CODE.format(k="l_suppkey")
STRAY_CODE = UNIT_CODE.format(
    k="(l_suppkey + CASE WHEN l_linenumber = 4 THEN 1000000007 ELSE 0 END)"
)

VAULT = {
    "partner_partner_h": "SELECT c_custkey AS MD_HKEY_PARTNER_ID, c_custkey AS PARTID FROM {customer}",
    "partner_partner_s": """
        SELECT o_custkey AS MD_HKEY_PARTNER_ID, o_orderstatus AS MANDANT,
               o_orderdate AS EROEFFZTPKTPART, o_orderpriority AS PARTKLS,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS TSAEND,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS SYS_START,
               o_orderkey AS SYS_END,
               o_orderpriority AS MD_HDIFF_ATTRIBUTES
        FROM {orders}""",
    "partner_natural_partner_person_s": """
        SELECT user_id AS MD_HKEY_PARTNER_ID, event_type AS MANDANT, props AS STANG, ts AS GEBDAT,
               CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS TSAEND,
               CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id END AS SYS_START, value AS SYS_END, props AS MD_HDIFF_ATTRIBUTES
        FROM {events}""",
    "partner_organisation_legal_person_s": """
        SELECT event_id % 500 AS MD_HKEY_PARTNER_ID, event_type AS MANDANT, value AS GRDGDAT,
               ts AS TSAEND, event_id AS SYS_START, value AS SYS_END, props AS MD_HDIFF_ATTRIBUTES
        FROM {events}""",
    "partner_postal_address_h": """
        SELECT o_orderkey AS MD_HKEY_POSTAL_ADDRESS_ID, o_custkey AS PARTID,
               o_orderstatus AS ADRNR
        FROM {orders}""",
    "partner_postal_address_s": """
        SELECT l_orderkey AS MD_HKEY_POSTAL_ADDRESS_ID, l_linenumber AS ADRNR,
               l_returnflag AS LANDBEZGPOSTADR,
               l_shipdate AS TSAEND, l_suppkey AS SYS_START, l_partkey AS SYS_END,
               l_linestatus AS MD_HDIFF_ATTRIBUTES
        FROM {lineitem}""",
    "partner_gesch_partner_h": """
        SELECT o_orderkey AS MD_HKEY_GESCH_PARTNER_ID, o_orderkey AS GESCHPARTID FROM {orders}""",
    "partner_gesch_partner_s": """
        SELECT l_orderkey AS MD_HKEY_GESCH_PARTNER_ID, l_partkey AS PARTID,
               l_returnflag AS GESCHPARTKLS, l_shipdate AS EROEFFZTPKTGESCHP,
               l_shipdate AS TSAEND,
               CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_linenumber END AS SYS_START,
               l_suppkey AS SYS_END, CAST(l_partkey AS STRING) AS MD_HDIFF_ATTRIBUTES
        FROM {lineitem}""",
    # The hubs of accounts and support repeat a key once per version.
    "partner_filialkunde_h": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS MD_HKEY_FILIALKUNDE_ID,
               l_orderkey AS GESCHPARTID, l_linenumber AS IDLFDNR
        FROM {lineitem}""",
    "partner_filialkunde_s": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS MD_HKEY_FILIALKUNDE_ID,
               l_partkey AS PARTID, l_linenumber AS FILKDELFDNR,
               l_returnflag AS FILKDESTOCKREGI, l_linestatus AS GESCHBERMERK,
               l_returnflag AS Brand, l_linestatus AS Kea, l_suppkey AS MANDANT,
               l_shipdate AS EROEFFZTPKTFILKDE, l_shipdate AS FILKDESCHLSZTPKT,
               l_quantity AS segkss, l_discount AS zielgrukss, l_tax AS TEILZIELGRUKSS,
               l_shipdate AS TSAEND, l_suppkey AS SYS_START, l_partkey AS SYS_END,
               CAST(l_partkey AS STRING) AS MD_HDIFF_ATTRIBUTES
        FROM {lineitem}""",
    "partner_account_manager_h": """
        SELECT s_suppkey AS MD_HKEY_ACCOUNT_MANAGER_ID,
               CAST(s_suppkey % 1000 AS INT) AS FIL, CAST(s_suppkey % 97 AS INT) AS BETREUNR,
               CAST((s_suppkey * 7) % 1000 AS INT) AS NIEDLNR,
               CAST(s_suppkey % 25 AS INT) AS EINSZBER
        FROM {supplier}""",
    "partner_account_manager_s": """
        SELECT l_suppkey AS MD_HKEY_ACCOUNT_MANAGER_ID, l_returnflag AS ERTRAGSTELLE,
               l_quantity AS MANDANT,
               l_shipdate AS TSAEND, l_orderkey AS SYS_START, l_linenumber AS SYS_END,
               CAST(l_partkey AS STRING) AS MD_HDIFF_ATTRIBUTES
        FROM {lineitem}""",
    "partner_customer_support_h": """
        SELECT concat(l_orderkey, '-', l_linenumber, '-', l_suppkey)
                   AS MD_HKEY_CUSTOMER_SUPPORT_ID,
               l_orderkey AS GESCHPARTID, l_linenumber AS IDLFDNR, l_suppkey AS BETREUEINHID
        FROM {lineitem}""",
    "partner_customer_support_s": f"""
        SELECT concat(l_orderkey, '-', l_linenumber, '-', l_suppkey)
                   AS MD_HKEY_CUSTOMER_SUPPORT_ID,
               {LINE_CODE} AS BETREU, l_returnflag AS BETREUART,
               l_shipdate AS TSAEND, l_partkey AS SYS_START, l_orderkey AS SYS_END,
               l_linestatus AS MD_HDIFF_ATTRIBUTES
        FROM {{lineitem}}""",
    "partner_branch_classification_h": """
        SELECT c_custkey AS MD_HKEY_BRANCH_CLASSIFICATION_ID, c_custkey AS PARTID
        FROM {customer}""",
    "partner_branch_classification_s": """
        SELECT user_id AS MD_HKEY_BRANCH_CLASSIFICATION_ID, event_type AS BRAZUORDBRAGRU,
               props AS BRAZUORDBRA, value AS BRAPROZ, event_type AS HPTBRA,
               ts AS TSAEND, event_id AS SYS_START, value AS SYS_END, props AS MD_HDIFF_ATTRIBUTES
        FROM {events}""",
}

# The nine feeds, with the constants of the static filters as the driver's tables have them.
FEEDS = dict(NINE_FEEDS)
FEEDS["Partner_Post_Addr"] = replace(FEEDS["Partner_Post_Addr"], equals={"ADRNR": 1})
FEEDS["Partner_Cust_Support"] = replace(FEEDS["Partner_Cust_Support"], equals={"BETREUART": "R"})
FEEDS["Partner_Industry"] = replace(FEEDS["Partner_Industry"], equals={"HPTBRA": "purchase"})

# Query name part and delta bound of each feed.
FEED_QUERIES = {
    "Partner_Info": ("partner_info", "2001-01-01"),
    "Partner_Natural_Person": ("natural_person", "2024-01-15"),
    "Partner_Org_Legal_Person": ("org_legal", "2024-01-15"),
    "Partner_Post_Addr": ("post_addr", "1999-01-01"),
    "Partner_Counterparty": ("counterparty", "1999-01-01"),
    "Partner_Filialkunde": ("account", "1999-01-01"),
    "Partner_Acct_Manager": ("acct_manager", "1999-01-01"),
    "Partner_Cust_Support": ("cust_support", "1999-01-01"),
    "Partner_Industry": ("industry", "2024-01-15"),
}

# Version tables of the flattened entities.
ENTITY_INPUTS = {
    "info": """
        SELECT o_custkey AS PARTID, o_orderpriority AS PARTKLS, o_orderdate AS TSAEND,
               o_orderkey AS info_order
        FROM {orders}""",
    "natural_person": """
        SELECT user_id AS PARTID, event_type AS STANG, ts AS TSAEND, event_id AS person_event
        FROM {events}""",
    "org_legal_person": """
        SELECT event_id % 500 AS PARTID, value AS GRDGDAT, ts AS TSAEND, event_id AS org_event
        FROM {events}""",
    "postal_address": """
        SELECT o_custkey + 1 AS PARTID, o_orderpriority AS LANDBEZGPOSTADR, o_orderdate AS TSAEND,
               o_orderkey AS address_order
        FROM {orders}""",
    "counterparty": """
        SELECT o_orderkey AS counterparty_id, o_custkey AS PARTID, o_orderstatus AS GESCHPARTKLS,
               o_orderdate AS TSAEND
        FROM {orders}""",
    # Some accounts name another partner than their counterparty does.
    "account": """
        SELECT l_orderkey AS counterparty_id, l_linenumber AS sequence_no,
               CASE WHEN l_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS PARTID,
               l_quantity AS segkss, l_shipdate AS TSAEND, l_suppkey AS account_supplier,
               l_partkey AS account_part
        FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    # The codes of some lines point to no manager.
    "support": f"""
        SELECT l_orderkey AS counterparty_id, l_linenumber AS sequence_no,
               l_suppkey AS BETREUEINHID, {STRAY_CODE} AS acct_mngr_unit_id,
               l_shipdate AS TSAEND, l_partkey AS support_part
        FROM {{lineitem}}""",
    "manager": """
        SELECT CAST(s_suppkey % 1000 AS INT) AS branch, CAST(s_suppkey % 97 AS INT) AS acct_mngr_id,
               CAST((s_suppkey * 7) % 1000 AS INT) AS acct_mngr_dept_id,
               CAST(s_suppkey % 25 AS INT) AS acct_mngr_area, s_name AS ERTRAGSTELLE,
               l_shipdate AS TSAEND, l_orderkey AS manager_order, l_linenumber AS manager_line,
               l_partkey AS manager_part
        FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey""",
}
TIE_BREAKS = {
    "info": ("info_order",),
    "natural_person": ("person_event",),
    "org_legal_person": ("org_event",),
    "postal_address": ("address_order",),
    "counterparty": (),
    "account": ("account_supplier", "account_part"),
    "support": ("support_part",),
    "manager": ("manager_order", "manager_line", "manager_part"),
}

# Managers whose key columns hold the code's parts in the flattening query's order.
OTHER_LAYOUT_MANAGERS = """
    SELECT CAST(s_suppkey % 25 AS INT) AS branch, CAST(s_suppkey % 97 AS INT) AS acct_mngr_id,
           CAST(s_suppkey % 1000 AS INT) AS acct_mngr_dept_id,
           CAST((s_suppkey * 7) % 1000 AS INT) AS acct_mngr_area, s_name AS ERTRAGSTELLE,
           l_shipdate AS TSAEND, l_orderkey AS manager_order, l_linenumber AS manager_line,
           l_partkey AS manager_part
    FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey"""

# Inputs of the flatten over all versions: partners, accounts and support rows have several
# versions each, which multiply.
HISTORY_INPUTS = {
    "info": "SELECT o_custkey AS PARTID, o_orderpriority AS PARTKLS, o_orderkey AS info_order FROM {orders}",
    "natural_person": "SELECT doc_id AS PARTID, quality AS STANG FROM {labels}",
    "org_legal_person": "SELECT s_suppkey AS PARTID, s_name AS GRDGDAT FROM {supplier}",
    "postal_address": "SELECT conv_id AS PARTID, turn AS address_turn, role AS LANDBEZGPOSTADR FROM {conversations}",
    "counterparty": """
        SELECT o_orderkey AS counterparty_id, o_custkey AS PARTID, o_orderdate AS TSAEND
        FROM {orders}""",
    "account": """
        SELECT l_orderkey AS counterparty_id, l_linenumber AS sequence_no, o_custkey AS PARTID,
               l_shipdate AS TSAEND, l_quantity AS segkss
        FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey""",
    "support": f"""
        SELECT l_orderkey AS counterparty_id, l_linenumber AS sequence_no,
               l_suppkey AS BETREUEINHID, {LINE_CODE} AS acct_mngr_unit_id, l_shipdate AS TSAEND
        FROM {{lineitem}}""",
    "manager": """
        SELECT CAST(s_suppkey % 1000 AS INT) AS branch, CAST(s_suppkey % 97 AS INT) AS acct_mngr_id,
               CAST((s_suppkey * 7) % 1000 AS INT) AS acct_mngr_dept_id,
               CAST(s_suppkey % 25 AS INT) AS acct_mngr_area, s_name AS ERTRAGSTELLE
        FROM {supplier}""",
}

_TABLE = re.compile(r"\{(\w+)\}")


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def proxy_frames(
    spark: SparkSession, sf_dir: str, texts: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Proxies as DataFrames over the driver's Parquet files, each file looked up once."""
    used = {name for text in texts.values() for name in _TABLE.findall(text)}
    tables = {name: driver_table(spark, sf_dir, name) for name in used}
    return {
        name: spark.sql(text, **{t: tables[t] for t in _TABLE.findall(text)})
        for name, text in texts.items()
    }


def proxy_sql(text: str) -> str:
    """A proxy as SQL over the views DuckDB has."""
    return f"({_TABLE.sub(lambda m: m.group(1), text).strip()})"
