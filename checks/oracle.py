"""The registered queries once more as SQL for DuckDB, written without the operators."""

from __future__ import annotations

from checks.proxies import (
    ENTITY_INPUTS,
    FEED_QUERIES,
    HISTORY_INPUTS,
    OTHER_LAYOUT_MANAGERS,
    TIE_BREAKS,
    UNIT_CODE,
    VAULT,
    proxy_sql,
)
from stammwerk.plans.entities import ENTITIES, FULL_CHAIN, SHORT_CHAIN

# (start, length) of branch, manager, department, area as the feeds and as the
# flattening query read the unit code.
FEED_PARTS = {"area": (2, 2), "manager": (4, 2), "branch": (6, 3), "department": (9, 3)}
FLATTEN_PARTS = {"branch": (2, 2), "manager": (4, 2), "department": (6, 3), "area": (9, 3)}
SUPPORT_NAMES = {
    "area": "Cast_EINSZBER",
    "manager": "CAST_BETREUNR",
    "branch": "CAST_FIL",
    "department": "CAST_NIEDLNR",
}


def _part(code: str, start: int, length: int) -> str:
    return f"CAST(substr(lpad(CAST({code} AS VARCHAR), 13, '0'), {start}, {length}) AS INT)"


# Per feed: hub, satellite, hash key, columns, and the condition besides the load type's,
# stated here once more so that a wrong specification shows.
FEED_TEXTS = {
    "Partner_Info": (
        "partner_partner_h", "partner_partner_s", "MD_HKEY_PARTNER_ID",
        "h.PARTID, s.MANDANT, s.EROEFFZTPKTPART, s.PARTKLS", "true"),
    "Partner_Natural_Person": (
        "partner_partner_h", "partner_natural_partner_person_s", "MD_HKEY_PARTNER_ID",
        "h.PARTID, s.MANDANT, s.STANG, s.GEBDAT", "true"),
    "Partner_Org_Legal_Person": (
        "partner_partner_h", "partner_organisation_legal_person_s", "MD_HKEY_PARTNER_ID",
        "h.PARTID, s.MANDANT, s.GRDGDAT", "true"),
    "Partner_Post_Addr": (
        "partner_postal_address_h", "partner_postal_address_s", "MD_HKEY_POSTAL_ADDRESS_ID",
        "h.PARTID, h.ADRNR, s.LANDBEZGPOSTADR", "s.ADRNR = 1"),
    "Partner_Counterparty": (
        "partner_gesch_partner_h", "partner_gesch_partner_s", "MD_HKEY_GESCH_PARTNER_ID",
        "h.GESCHPARTID, s.PARTID, s.GESCHPARTKLS, s.EROEFFZTPKTGESCHP", "true"),
    "Partner_Filialkunde": (
        "partner_filialkunde_h", "partner_filialkunde_s", "MD_HKEY_FILIALKUNDE_ID",
        "h.GESCHPARTID, h.IDLFDNR, s.PARTID, s.FILKDELFDNR, s.FILKDESTOCKREGI, s.GESCHBERMERK,"
        " s.Brand, s.Kea, s.MANDANT, s.EROEFFZTPKTFILKDE, s.FILKDESCHLSZTPKT, s.segkss,"
        " s.zielgrukss, s.TEILZIELGRUKSS", "true"),
    "Partner_Acct_Manager": (
        "partner_account_manager_h", "partner_account_manager_s", "MD_HKEY_ACCOUNT_MANAGER_ID",
        "h.FIL, h.BETREUNR, h.NIEDLNR, h.EINSZBER, s.ERTRAGSTELLE, s.MANDANT", "true"),
    "Partner_Cust_Support": (
        "partner_customer_support_h", "partner_customer_support_s", "MD_HKEY_CUSTOMER_SUPPORT_ID",
        "h.GESCHPARTID, h.IDLFDNR, h.BETREUEINHID, s.BETREU, s.BETREUART", "s.BETREUART = 'R'"),
    "Partner_Industry": (
        "partner_branch_classification_h", "partner_branch_classification_s",
        "MD_HKEY_BRANCH_CLASSIFICATION_ID",
        "h.PARTID, s.BRAZUORDBRAGRU, s.BRAZUORDBRA, s.BRAPROZ, s.HPTBRA", "s.HPTBRA = 'purchase'"),
}


def _feed(name: str, load_type: str, latest: bool, since: str | None = None) -> str:
    hub, satellite, key, columns, condition = FEED_TEXTS[name]
    if name == "Partner_Cust_Support":
        columns += "".join(
            f", {_part('s.BETREU', *FEED_PARTS[part])} AS {alias}"
            for part, alias in SUPPORT_NAMES.items()
        )
    columns += ", s.TSAEND, s.SYS_START, s.SYS_END, s.MD_HDIFF_ATTRIBUTES"
    changed = (
        "s.SYS_START IS NOT NULL"
        if load_type == "initial"
        else f"s.TSAEND > TIMESTAMP '{since or FEED_QUERIES[name][1]}'"
    )
    order = (
        "s.TSAEND DESC NULLS LAST, s.SYS_START DESC NULLS LAST, s.SYS_END DESC NULLS LAST"
        if latest
        else "s.TSAEND ASC NULLS FIRST, s.SYS_START ASC NULLS FIRST, s.SYS_END DESC NULLS LAST"
    )
    return f"""
        SELECT {columns}
        FROM {proxy_sql(VAULT[satellite])} s, {proxy_sql(VAULT[hub])} h
        WHERE h.{key} = s.{key} AND {condition} AND {changed}
        QUALIFY row_number() OVER (
            PARTITION BY h.{key}
            ORDER BY {order}, s.MD_HDIFF_ATTRIBUTES ASC NULLS FIRST) = 1"""


def _feeds() -> dict[str, str]:
    found = {}
    for name, (part, _) in FEED_QUERIES.items():
        for load_type in ("initial", "delta"):
            found[f"feed_{part}_{load_type}"] = _feed(name, load_type, False)
            found[f"feed_{part}_{load_type}_latest"] = _feed(name, load_type, True)
    return found


def _current(text: str, keys, tie_break) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ("TSAEND", *tie_break))
    return f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS rn
            FROM {text}) ranked
        WHERE rn = 1"""


def _current_entity(name: str) -> str:
    return _current(proxy_sql(ENTITY_INPUTS[name]), ENTITIES[name].keys, TIE_BREAKS[name])


# Output columns of the flatten queries as (entity, column, output name).
SHORT_COLUMNS = """
    info.PARTID, info.PARTKLS, info.TSAEND AS info_TSAEND, info.info_order,
    counterparty.counterparty_id AS counterparty_counterparty_id,
    counterparty.PARTID AS counterparty_PARTID, counterparty.GESCHPARTKLS,
    counterparty.TSAEND AS counterparty_TSAEND,
    account.counterparty_id AS account_counterparty_id,
    account.sequence_no AS account_sequence_no, account.PARTID AS account_PARTID,
    account.segkss, account.TSAEND AS account_TSAEND, account.account_supplier,
    account.account_part,
    support.counterparty_id AS support_counterparty_id,
    support.sequence_no AS support_sequence_no, support.BETREUEINHID,
    support.acct_mngr_unit_id, support.TSAEND AS support_TSAEND, support.support_part,
    manager.branch, manager.acct_mngr_id, manager.acct_mngr_dept_id, manager.acct_mngr_area,
    manager.ERTRAGSTELLE, manager.TSAEND AS manager_TSAEND, manager.manager_order,
    manager.manager_line, manager.manager_part"""
PERSON_COLUMNS = """,
    natural_person.PARTID AS natural_person_PARTID, natural_person.STANG,
    natural_person.TSAEND AS natural_person_TSAEND, natural_person.person_event,
    org_legal_person.PARTID AS org_legal_person_PARTID, org_legal_person.GRDGDAT,
    org_legal_person.TSAEND AS org_legal_person_TSAEND, org_legal_person.org_event,
    postal_address.PARTID AS postal_address_PARTID, postal_address.LANDBEZGPOSTADR,
    postal_address.TSAEND AS postal_address_TSAEND, postal_address.address_order"""
HISTORY_COLUMNS = """
    info.PARTID, info.PARTKLS, info.info_order,
    natural_person.PARTID AS natural_person_PARTID, natural_person.STANG,
    org_legal_person.PARTID AS org_legal_person_PARTID, org_legal_person.GRDGDAT,
    postal_address.PARTID AS postal_address_PARTID, postal_address.address_turn,
    postal_address.LANDBEZGPOSTADR,
    counterparty.counterparty_id AS counterparty_counterparty_id,
    counterparty.PARTID AS counterparty_PARTID, counterparty.TSAEND AS counterparty_TSAEND,
    account.counterparty_id AS account_counterparty_id,
    account.sequence_no AS account_sequence_no, account.PARTID AS account_PARTID,
    account.TSAEND AS account_TSAEND, account.segkss,
    support.counterparty_id AS support_counterparty_id,
    support.sequence_no AS support_sequence_no, support.BETREUEINHID,
    support.acct_mngr_unit_id, support.TSAEND AS support_TSAEND,
    manager.branch, manager.acct_mngr_id, manager.acct_mngr_dept_id, manager.acct_mngr_area,
    manager.ERTRAGSTELLE"""
PERSON_JOINS = """
    LEFT JOIN natural_person ON natural_person.PARTID = info.PARTID
    LEFT JOIN org_legal_person ON org_legal_person.PARTID = info.PARTID
    LEFT JOIN postal_address ON postal_address.PARTID = info.PARTID"""
def _account_joins(parts: dict[str, tuple[int, int]]) -> str:
    code = "support.acct_mngr_unit_id"
    return f"""
    LEFT JOIN counterparty ON counterparty.PARTID = info.PARTID
    LEFT JOIN account ON account.PARTID = info.PARTID
         AND account.counterparty_id = counterparty.counterparty_id
    LEFT JOIN support ON support.counterparty_id = account.counterparty_id
         AND support.sequence_no = account.sequence_no
    LEFT JOIN manager ON manager.branch = {_part(code, *parts['branch'])}
         AND manager.acct_mngr_id = {_part(code, *parts['manager'])}
         AND manager.acct_mngr_dept_id = {_part(code, *parts['department'])}
         AND manager.acct_mngr_area = {_part(code, *parts['area'])}"""


def _flatten(inputs: dict[str, str], columns: str, persons: bool, parts=None) -> str:
    ctes = ", ".join(f"{name} AS ({text})" for name, text in inputs.items())
    joins = (PERSON_JOINS if persons else "") + _account_joins(parts or FEED_PARTS)
    return f"WITH {ctes} SELECT {columns} FROM info {joins}"


def _feeds_to_flatten() -> str:
    tie_break = ("SYS_START", "SYS_END", "MD_HDIFF_ATTRIBUTES")
    metadata = "{e}.TSAEND AS {e}_TSAEND, {e}.SYS_START AS {e}_SYS_START, {e}.SYS_END AS {e}_SYS_END, {e}.MD_HDIFF_ATTRIBUTES AS {e}_MD_HDIFF_ATTRIBUTES"
    partner = "(SELECT f.* EXCLUDE (PARTID), o_custkey AS PARTID FROM ({}) f JOIN orders ON o_orderkey = f.GESCHPARTID)"
    staged = {
        "info": ("Partner_Info", "", "PARTID"),
        "natural_person": ("Partner_Natural_Person", "", "PARTID"),
        "org_legal_person": ("Partner_Org_Legal_Person", "", "PARTID"),
        "postal_address": ("Partner_Post_Addr", "", "PARTID"),
        "counterparty": ("Partner_Counterparty", "GESCHPARTID AS counterparty_id", "GESCHPARTID"),
        "account": (
            "Partner_Filialkunde",
            "GESCHPARTID AS counterparty_id, IDLFDNR AS sequence_no",
            "GESCHPARTID, IDLFDNR",
        ),
        "support": (
            "Partner_Cust_Support",
            "GESCHPARTID AS counterparty_id, IDLFDNR AS sequence_no, BETREU AS acct_mngr_unit_id",
            "GESCHPARTID, IDLFDNR, BETREUEINHID",
        ),
        "manager": (
            "Partner_Acct_Manager",
            "FIL AS branch, BETREUNR AS acct_mngr_id, NIEDLNR AS acct_mngr_dept_id,"
            " EINSZBER AS acct_mngr_area",
            "FIL, BETREUNR, NIEDLNR, EINSZBER",
        ),
    }
    inputs = {}
    for name, (feed, renamed, keys) in staged.items():
        text = f"({_feed(feed, 'initial', True)})"
        if name in ("counterparty", "account"):
            text = partner.format(_feed(feed, "initial", True))
        current = _current(text, [keys], tie_break)
        if renamed:
            old = [part.split(" AS ")[0].strip() for part in renamed.split(",")]
            current = f"SELECT * EXCLUDE ({', '.join(old)}), {renamed} FROM ({current})"
        inputs[name] = current
    columns = (
        "info.PARTID, info.MANDANT AS info_MANDANT, info.EROEFFZTPKTPART, info.PARTKLS,"
        " natural_person.PARTID AS natural_person_PARTID,"
        " natural_person.MANDANT AS natural_person_MANDANT, natural_person.STANG,"
        " natural_person.GEBDAT, org_legal_person.PARTID AS org_legal_person_PARTID,"
        " org_legal_person.MANDANT AS org_legal_person_MANDANT, org_legal_person.GRDGDAT,"
        " postal_address.PARTID AS postal_address_PARTID, postal_address.ADRNR,"
        " postal_address.LANDBEZGPOSTADR,"
        " counterparty.counterparty_id AS counterparty_counterparty_id,"
        " counterparty.PARTID AS counterparty_PARTID, counterparty.GESCHPARTKLS,"
        " counterparty.EROEFFZTPKTGESCHP,"
        " account.counterparty_id AS account_counterparty_id,"
        " account.sequence_no AS account_sequence_no, account.PARTID AS account_PARTID,"
        " account.FILKDELFDNR, account.FILKDESTOCKREGI, account.GESCHBERMERK, account.Brand,"
        " account.Kea, account.MANDANT AS account_MANDANT, account.EROEFFZTPKTFILKDE,"
        " account.FILKDESCHLSZTPKT, account.segkss, account.zielgrukss, account.TEILZIELGRUKSS,"
        " support.counterparty_id AS support_counterparty_id,"
        " support.sequence_no AS support_sequence_no, support.BETREUEINHID,"
        " support.acct_mngr_unit_id, support.BETREUART, support.Cast_EINSZBER,"
        " support.CAST_BETREUNR, support.CAST_FIL, support.CAST_NIEDLNR,"
        " manager.branch, manager.acct_mngr_id, manager.acct_mngr_dept_id,"
        " manager.acct_mngr_area, manager.ERTRAGSTELLE, manager.MANDANT AS manager_MANDANT, "
        + ", ".join(metadata.format(e=name) for name in staged)
    )
    return _flatten(inputs, columns, True)


def _feed_plan(load_type: str) -> str:
    texts = []
    for job, target, partition, cluster, feed, hub_key, extra in (
        ("daily_vault_Partner_Info", "staging.partner", "md_book_date", "PARTID,md_book_date",
         "partner_partner", "MD_HKEY_PARTNER_ID", ""),
        ("daily_vault_Partner_Counterparty", "staging.counterparty", "", "",
         "partner_gesch_partner", "MD_HKEY_GESCH_PARTNER_ID", ", s.PARTID"),
    ):
        partid = "s.PARTID" if extra else "h.PARTID"
        condition = (
            "s.SYS_START IS NOT NULL"
            if load_type == "initial"
            else "s.TSAEND > TIMESTAMP '1999-06-30'"
        )
        texts.append(f"""
            SELECT '{job}' AS job, '{target}' AS target, '{partition}' AS partition_columns,
                   '{cluster}' AS cluster_columns, {partid} AS PARTID, s.TSAEND, s.SYS_END
            FROM {proxy_sql(VAULT[feed + '_s'])} s
            JOIN {proxy_sql(VAULT[feed + '_h'])} h ON h.{hub_key} = s.{hub_key}
            WHERE {condition}
            QUALIFY row_number() OVER (PARTITION BY h.{hub_key}
                ORDER BY s.TSAEND ASC NULLS FIRST, s.SYS_START ASC NULLS FIRST,
                         s.SYS_END DESC NULLS LAST{extra}) = 1""")
    return " UNION ALL ".join(f"({t})" for t in texts)


def _decode() -> str:
    code = UNIT_CODE.format(k="l_suppkey")
    parts = [
        f"{_part(f'({code})', *place)} AS {prefix}_{part}"
        for prefix, layout in (("feed", FEED_PARTS), ("flatten", FLATTEN_PARTS))
        for part, place in layout.items()
    ]
    return f"SELECT l_orderkey, l_linenumber, {code} AS code, {', '.join(parts)} FROM lineitem"


def _decode_lenient() -> str:
    code = "concat('0', substr(o_orderpriority, 1, 1), '0A', o_orderkey)"
    parts = ", ".join(
        f"TRY_CAST(substr(lpad({code}, 13, '0'), {start}, {length}) AS INT) AS {part}"
        for part, (start, length) in FEED_PARTS.items()
    )
    return f"SELECT o_orderkey, {parts} FROM orders"


EXACT_TOTAL = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE)"


def _gated(written: bool, failed: str, total: str = EXACT_TOTAL) -> str:
    base = """
        SELECT CAST(o_orderkey AS INT) AS o_orderkey, CAST(o_custkey AS INT) AS o_custkey,
               {total} AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus,
               {written} AS written, '{failed}' AS failed_checks
        FROM orders"""
    rows = {"written": written, "failed": failed}
    text = base.format(total=EXACT_TOTAL, **rows) + " WHERE o_orderstatus = 'F'"
    if written:
        text += " UNION ALL " + base.format(total=total, **rows)
    return text


def _migrated(
    steps: str, refused: str = "", key: str = "INT", customer: str = "INT", total: str = EXACT_TOTAL,
    note: str = "NULL",
) -> str:
    base = """
        SELECT CAST(o_orderkey AS {key}) AS o_orderkey, CAST(o_custkey AS {customer}) AS o_custkey,
               {total} AS o_totalprice, o_orderstatus, o_orderpriority,
               CAST({note} AS VARCHAR) AS o_note, {written} AS written,
               '{steps}' AS steps, '{refused}' AS refused
        FROM orders"""
    rows = {"key": key, "customer": customer, "written": not refused, "steps": steps, "refused": refused}
    text = base.format(total=EXACT_TOTAL, note="NULL", **rows) + " WHERE o_orderstatus = 'F'"
    if not refused:
        text += " UNION ALL " + base.format(total=total, note=note, **rows)
    return text


def _migrations() -> dict[str, str]:
    late = "'late ' || o_orderpriority"
    return {
        "migrate_missing_field": _migrated("add o_note string", note=late),
        "migrate_wider": _migrated("add o_note string; widen o_orderkey bigint", key="BIGINT", note=late),
        "migrate_wider_bucket": _migrated("widen o_custkey bigint", customer="BIGINT"),
        "migrate_narrower_frame": _migrated(
            "convert o_totalprice decimal(18,2)", total=f"floor({EXACT_TOTAL})"
        ),
        "migrate_layout": _migrated(
            "relocate o_orderpriority,o_orderstatus partition_columns;"
            " relocate o_orderkey,o_custkey cluster_columns"
        ),
        "migrate_refused": _migrated(
            "add o_note string",
            "mode strict does not know bigint; the frame''s rows would have no partition",
        ),
    }


def _gates() -> dict[str, str]:
    return {
        "gate_ok": _gated(True, ""),
        "gate_extra_target_field": _gated(True, "", "CAST(NULL AS DOUBLE)"),
        "gate_missing_field": _gated(False, "field_exists:o_note"),
        "gate_type_mismatch_strict": _gated(False, "type:o_orderkey"),
        "gate_wide": _gated(True, ""),
        "gate_partition": _gated(False, "partition_columns"),
        "gate_partition_absent": _gated(False, "partition_field:o_orderstatus"),
        "gate_cluster_set": _gated(True, ""),
        "gate_cluster_other": _gated(False, "cluster_columns"),
        "gate_missing_table": """
            SELECT o_orderkey, false AS written, 'target_exists' AS failed_checks FROM orders""",
        "gate_wide_narrowing_blocked": """
            SELECT CAST(o_orderkey AS INT) AS o_orderkey, false AS written,
                   'type:o_orderkey,type:o_totalprice' AS failed_checks
            FROM orders""",
        "gated_write_blocked": _gated(False, "field_exists:O_TOTALPRICE"),
    }


def _job_run_feed() -> str:
    return " UNION ALL ".join(
        f"""SELECT *, '{book_date}' AS md_book_date, 'checks' AS md_load_user,
                   '{load_type}' AS md_load_type
            FROM ({_feed('Partner_Info', load_type, False)})"""
        for load_type, book_date in (("initial", "2024-06-28"), ("delta", "2024-06-30"))
    )


FEED_KEYS = {
    "Partner_Info": "PARTID", "Partner_Natural_Person": "PARTID",
    "Partner_Org_Legal_Person": "PARTID", "Partner_Post_Addr": "PARTID",
    "Partner_Counterparty": "GESCHPARTID", "Partner_Filialkunde": "GESCHPARTID",
    "Partner_Acct_Manager": "FIL", "Partner_Cust_Support": "GESCHPARTID",
    "Partner_Industry": "PARTID",
}


def _job_run_feeds() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS feed, CAST({key} AS BIGINT) AS key, TSAEND, MD_HDIFF_ATTRIBUTES,
                   '{book_date}' AS md_book_date, '{load_type}' AS md_load_type
            FROM ({_feed(name, load_type, False, '2000-06-30')})"""
        for name, key in FEED_KEYS.items()
        for load_type, book_date in (("initial", "2024-06-28"), ("delta", "2024-06-30"))
    )


def _job_run_declared_feed() -> str:
    return " UNION ALL ".join(
        f"""SELECT l_orderkey AS ORDER_ID, l_quantity AS QUANTITY, l_shipdate AS TSAEND,
                   l_suppkey AS SYS_START, l_partkey AS SYS_END, l_returnflag AS MD_HDIFF_ATTRIBUTES,
                   '{book_date}' AS md_book_date, 'checks' AS md_load_user, '{load_type}' AS md_load_type
            FROM lineitem JOIN orders ON o_orderkey = l_orderkey
            WHERE l_linenumber = 2 AND {condition}
            QUALIFY row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_shipdate, l_suppkey, l_partkey DESC, l_returnflag) = 1"""
        for load_type, book_date, condition in (
            ("initial", "2024-06-28", "l_suppkey IS NOT NULL"),
            ("delta", "2024-06-30", "l_shipdate > TIMESTAMP '1999-06-30'"))
    )


def _run_feeds_one_fails() -> str:
    loaded = " UNION ALL ".join(
        f"""SELECT '{name}' AS feed, CAST({FEED_KEYS[name]} AS BIGINT) AS key,
                   true AS written, false AS failed FROM ({_feed(name, 'initial', False)})"""
        for name in ("Partner_Info", "Partner_Counterparty")
    )
    return loaded + " UNION ALL SELECT 'Broken', NULL, false, true"


def _job_run_feeds_text() -> str:
    return " UNION ALL ".join(
        f"""SELECT substr(job, 13) AS feed, PARTID, TSAEND, SYS_END, '{load_type}' AS md_load_type
            FROM ({_feed_plan(load_type)})"""
        for load_type in ("initial", "delta")
    )


def _one_per_time(name: str, keys: str) -> str:
    """One version of each key and change date."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in TIE_BREAKS[name]) or "1"
    return f"""
        SELECT * FROM {proxy_sql(ENTITY_INPUTS[name])}
        QUALIFY row_number() OVER (PARTITION BY {keys}, TSAEND ORDER BY {order}) = 1"""


HISTORY_ATTRIBUTES = {
    "info": "PARTKLS",
    "natural_person": "STANG",
    "counterparty": "struct_pack(a := PARTID, b := GESCHPARTKLS)",
    "account": "struct_pack(a := PARTID, b := segkss)",
    "support": "acct_mngr_unit_id",
    "manager": "ERTRAGSTELLE",
}


def _history(name: str) -> str:
    keys, state = ", ".join(ENTITIES[name].keys), HISTORY_ATTRIBUTES[name]
    return f"""
        SELECT * EXCLUDE (TSAEND, begins), TSAEND AS valid_from,
               lead(TSAEND) OVER (PARTITION BY {keys} ORDER BY TSAEND) AS valid_to
        FROM (
            SELECT *, row_number() OVER w = 1 OR lag({state}) OVER w IS DISTINCT FROM {state} AS begins
            FROM ({_one_per_time(name, keys)})
            WINDOW w AS (PARTITION BY {keys} ORDER BY TSAEND))
        WHERE begins"""


PARTNER_ENTITY_COLUMNS = {
    "info": ("PARTKLS", "TSAEND", "info_order"),
    "natural_person": ("STANG", "TSAEND", "person_event"),
    "org_legal_person": ("GRDGDAT", "TSAEND", "org_event"),
    "postal_address": ("LANDBEZGPOSTADR", "TSAEND", "address_order"),
}


def _timeline_partner() -> str:
    """Each change date of a partner with every entity's version found for it alone."""
    ctes = ", ".join(f"{n} AS ({_one_per_time(n, 'PARTID')})" for n in PARTNER_ENTITY_COLUMNS)
    times = " UNION ".join(f"SELECT PARTID, TSAEND AS valid_from FROM {n}" for n in PARTNER_ENTITY_COLUMNS)
    joins = " ".join(
        f"ASOF LEFT JOIN {n} ON {n}.PARTID = times.PARTID AND times.valid_from >= {n}.TSAEND"
        for n in PARTNER_ENTITY_COLUMNS
    )
    columns = ", ".join(f"{n}.{c} AS {n}_{c}" for n, cs in PARTNER_ENTITY_COLUMNS.items() for c in cs)
    return f"""
        WITH {ctes}, times AS ({times})
        SELECT times.PARTID, times.valid_from,
               lead(times.valid_from) OVER (PARTITION BY times.PARTID ORDER BY times.valid_from) AS valid_to,
               {columns}
        FROM times {joins}
        QUALIFY info.PARTID IS NOT NULL"""


def _versions_valid(name: str, keys: str) -> str:
    """The versions of an entity with the times (f, t) between which they are valid."""
    return f"""
        SELECT *, TSAEND AS f,
               coalesce(lead(TSAEND) OVER (PARTITION BY {keys} ORDER BY TSAEND), TIMESTAMP 'infinity') AS t
        FROM ({_one_per_time(name, keys)})"""


def _flatten_short_intervals() -> str:
    """Each interval against each version by their times, then the gaps between what was found."""
    code = "s.support.acct_mngr_unit_id"
    levels = (
        ("counterparty", "counterparty_id", "r.PARTID = s.info.PARTID"),
        ("account", "counterparty_id, sequence_no",
         "r.PARTID = s.info.PARTID AND r.counterparty_id = s.counterparty.counterparty_id"),
        ("support", "counterparty_id, sequence_no, BETREUEINHID",
         "r.counterparty_id = s.account.counterparty_id AND r.sequence_no = s.account.sequence_no"),
        ("manager", "branch, acct_mngr_id, acct_mngr_dept_id, acct_mngr_area",
         " AND ".join(f"r.{c} = {_part(code, *FEED_PARTS[p])}" for p, c in (
             ("branch", "branch"), ("manager", "acct_mngr_id"), ("department", "acct_mngr_dept_id"),
             ("area", "acct_mngr_area")))),
    )
    ctes = [f"info_v AS ({_versions_valid('info', 'PARTID')})",
            "info_s AS (SELECT row_number() OVER () AS id, f, t, i AS info FROM info_v i)"]
    last, structs = "info_s", ["info"]
    for name, keys, on in levels:
        carried = ", ".join(f"s.{x}" for x in structs)
        ctes += [
            f"{name}_v AS ({_versions_valid(name, keys)})",
            f"""{name}_m AS MATERIALIZED (
                SELECT s.id AS sid, greatest(s.f, r.f) AS f, least(s.t, r.t) AS t, {carried}, r AS {name}
                FROM {last} s JOIN {name}_v r ON {on} AND s.f < r.t AND r.f < s.t)""",
            f"""{name}_g AS (
                SELECT s.id AS sid, coalesce(max(m.t) OVER (PARTITION BY m.sid ORDER BY m.f, m.t
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s.f) AS f, m.f AS t
                FROM {name}_m m JOIN {last} s ON s.id = m.sid
                UNION ALL
                SELECT s.id, coalesce(x.t, s.f), s.t
                FROM {last} s LEFT JOIN (SELECT sid, max(t) AS t FROM {name}_m GROUP BY sid) x ON x.sid = s.id)""",
            f"""{name}_s AS MATERIALIZED (
                SELECT row_number() OVER () AS id, * EXCLUDE (sid) FROM (
                    SELECT * FROM {name}_m
                    UNION ALL BY NAME
                    SELECT g.sid, g.f, g.t, {carried} FROM {name}_g g JOIN {last} s ON s.id = g.sid WHERE g.f < g.t))""",
        ]
        last = f"{name}_s"
        structs.append(name)
    return f"""
        WITH {', '.join(ctes)}
        SELECT {SHORT_COLUMNS}, f AS valid_from, nullif(t, TIMESTAMP 'infinity') AS valid_to FROM {last}"""


def _as_of_accounts() -> str:
    return f"""
        SELECT a.*, i.PARTKLS AS info_PARTKLS, i.TSAEND AS info_TSAEND, i.info_order AS info_info_order
        FROM {proxy_sql(ENTITY_INPUTS['account'])} a
        ASOF LEFT JOIN ({_one_per_time('info', 'PARTID')}) i ON i.PARTID = a.PARTID AND a.TSAEND >= i.TSAEND"""


def _profile_lineitem() -> str:
    lines = proxy_sql(VAULT["partner_gesch_partner_s"])
    repeats = f"""
        SELECT CAST(sum(n - 1) AS BIGINT) FROM (
            SELECT count(*) AS n FROM {lines} GROUP BY GESCHPARTKLS, MD_HKEY_GESCH_PARTNER_ID)"""
    columns = ("MD_HKEY_GESCH_PARTNER_ID", "PARTID", "GESCHPARTKLS", "EROEFFZTPKTGESCHP", "TSAEND",
               "SYS_START", "SYS_END", "MD_HDIFF_ATTRIBUTES")
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count(*) AS rows, count(*) - count({c}) AS nulls,
                   ({repeats}) AS repeats, true AS near FROM {lines}"""
        for c in columns
    )


def oracle_sql() -> dict[str, str]:
    entities = {name: _current_entity(name) for name in ENTITY_INPUTS}
    histories = {name: f"SELECT * FROM {proxy_sql(text)}" for name, text in HISTORY_INPUTS.items()}
    short = {entity.name: entities[entity.name] for entity in SHORT_CHAIN}
    full = {entity.name: entities[entity.name] for entity in FULL_CHAIN}
    flatten_short = _flatten(short, SHORT_COLUMNS, False)
    flatten_full = _flatten(full, SHORT_COLUMNS + PERSON_COLUMNS, True)
    return {
        **_feeds(),
        **{
            f"changes_{FEED_QUERIES[name][0]}": _feed(name, "initial", True)
            for name in ("Partner_Info", "Partner_Filialkunde", "Partner_Cust_Support", "Partner_Industry")
        },
        "changes_delivered": f"""
            SELECT PARTID, MANDANT, EROEFFZTPKTPART, PARTKLS FROM ({_feed('Partner_Info', 'initial', True)})""",
        **{f"current_{name}": text for name, text in entities.items()},
        "current_views": f"""
            SELECT p.PARTID, p.info_order, c.counterparty_id, c.GESCHPARTKLS
            FROM ({entities['info']}) p JOIN ({entities['counterparty']}) c ON c.PARTID = p.PARTID""",
        "current_tables": f"""
            SELECT a.counterparty_id, a.sequence_no, a.segkss, s.BETREUEINHID
            FROM ({entities['account']}) a JOIN ({entities['support']}) s
              ON s.counterparty_id = a.counterparty_id AND s.sequence_no = a.sequence_no""",
        "flatten_short": flatten_short,
        "flatten_full": flatten_full,
        "flatten_full_spread": flatten_full,
        "flatten_all_versions": _flatten(histories, HISTORY_COLUMNS, True),
        "flatten_all_versions_protected": _flatten(histories, HISTORY_COLUMNS, True),
        "flatten_short_other_layout": _flatten(
            short | {"manager": _current(
                proxy_sql(OTHER_LAYOUT_MANAGERS), ENTITIES["manager"].keys, TIE_BREAKS["manager"])},
            SHORT_COLUMNS, False, FLATTEN_PARTS,
        ),
        "flatten_short_from_current": flatten_short,
        "flatten_full_from_current": flatten_full,
        **{f"current_{name}_refreshed": text for name, text in entities.items()},
        "flatten_short_from_refreshed": flatten_short,
        **{f"history_{name}": _history(name) for name in HISTORY_ATTRIBUTES},
        "timeline_partner": _timeline_partner(),
        "as_of_accounts": _as_of_accounts(),
        "intervals_short": _flatten_short_intervals(),
        "stream_current_account": entities["account"],
        "profile_lineitem": _profile_lineitem(),
        "flatten_rollup": f"""
            SELECT branch, acct_mngr_dept_id, acct_mngr_id,
                   grouping(branch, acct_mngr_dept_id, acct_mngr_id) AS grouping,
                   count(*) AS rows, count(DISTINCT PARTID) AS distinct,
                   sum(coalesce(segkss, 0.0)) AS quantity
            FROM ({flatten_short}) GROUP BY CUBE (branch, acct_mngr_dept_id, acct_mngr_id)""",
        "reconcile_orders": """
            WITH copy AS (
                SELECT * REPLACE (CASE WHEN o_orderkey BETWEEN 900 AND 904 THEN 1.0 ELSE o_totalprice END
                                  AS o_totalprice)
                FROM orders WHERE o_orderkey NOT BETWEEN 300 AND 309
                UNION ALL SELECT * FROM orders WHERE o_orderkey BETWEEN 600 AND 607)
            SELECT *, 'left' AS side, 1 AS times, false AS equal FROM (FROM orders EXCEPT ALL FROM copy)
            UNION ALL
            SELECT *, 'right', 1, false FROM (FROM copy EXCEPT ALL FROM orders)""",
        "unit_code_decode": _decode(),
        "unit_code_decode_lenient": _decode_lenient(),
        "stamp_metadata": """
            SELECT *, '2024-06-30' AS md_book_date, 'checks' AS md_load_user,
                   'partnerdata' AS md_source_system, true AS one_load_date
            FROM customer""",
        "scan_query": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'",
        "scan_table": "SELECT * FROM orders",
        "scan_path": "SELECT * FROM supplier",
        "scan_sql_file": """
            SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""",
        "scan_view": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "scan_explicit_schema": """
            SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS note FROM customer""",
        "bound_parameter": """
            SELECT o_orderkey, o_orderdate FROM orders
            WHERE o_orderdate > TIMESTAMP '2000-06-30'""",
        "feed_plan_initial": _feed_plan("initial"),
        "feed_plan_delta": _feed_plan("delta"),
        "sink_overwrite": "SELECT * FROM orders",
        "sink_initial_dynamic_mode": "SELECT * FROM orders WHERE o_orderstatus = 'F'",
        "sink_append": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "sink_append_fewer_columns": """
            SELECT * FROM orders UNION ALL
            SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE),
                   CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR)
            FROM orders""",
        "sink_partitioned": "SELECT * FROM orders",
        "sink_partition_replaced": """
            SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN 0.0 ELSE o_totalprice END
                              AS o_totalprice)
            FROM orders""",
        "sink_bucketed": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
        "sink_clustered_path": "SELECT * FROM orders",
        "sink_curve": "SELECT * FROM lineitem",
        "curve_range_part": "SELECT * FROM lineitem WHERE l_partkey BETWEEN 10 AND 20",
        "curve_range_supplier": "SELECT * FROM lineitem WHERE l_suppkey <= 3",
        "curve_range_date": """
            SELECT * FROM lineitem
            WHERE l_shipdate BETWEEN TIMESTAMP '1995-03-01' AND TIMESTAMP '1995-04-15'""",
        **_gates(),
        **_migrations(),
        "job_run_feed": _job_run_feed(),
        "job_run_feeds": _job_run_feeds(),
        "job_run_feeds_text": _job_run_feeds_text(),
        "job_run_feeds_once": _job_run_feeds(),
        "job_run_declared_feed": _job_run_declared_feed(),
        "run_feeds_one_fails": _run_feeds_one_fails(),
        "job_run_flatten_query_file": f"""
            SELECT p.PARTID, p.PARTKLS, c.counterparty_id, a.sequence_no, a.segkss,
                   '2024-06-30' AS md_book_date, 'checks' AS md_load_user,
                   'partnerdata' AS md_source_system
            FROM ({entities['info']}) p
            LEFT JOIN ({entities['counterparty']}) c ON c.PARTID = p.PARTID
            LEFT JOIN ({entities['account']}) a
                   ON a.PARTID = p.PARTID AND a.counterparty_id = c.counterparty_id""",
        "job_run_flatten": f"""
            SELECT *, '2024-06-30' AS md_book_date, 'checks' AS md_load_user,
                   'partnerdata' AS md_source_system
            FROM ({flatten_short})""",
        "feeds_to_flatten": _feeds_to_flatten(),
    }
