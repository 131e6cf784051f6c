"""The flattened entities: table, current-row key, and how they hang together."""

from __future__ import annotations

from dataclasses import dataclass

PARTNER = "PARTID"
COUNTERPARTY = "counterparty_id"
SEQUENCE = "sequence_no"
SUPPORT_UNIT = "BETREUEINHID"
UNIT_CODE = "acct_mngr_unit_id"


@dataclass(frozen=True)
class Entity:
    name: str
    table: str
    keys: tuple[str, ...]
    # What current rows are stored by: the columns of the joins they take part in.
    join_keys: tuple[str, ...] = ()
    # Decides, descending, between rows of one key with the same change date.
    tie_break: tuple[str, ...] = ("SYS_START", "SYS_END", "MD_HDIFF_ATTRIBUTES")

    @property
    def view(self) -> str:
        return f"v_{self.table}_current"


# Tables, current-row keys, and column names of the manager table.
INFO = Entity("info", "partner_info", (PARTNER,), (PARTNER,))
NATURAL_PERSON = Entity("natural_person", "partner_natural_person", (PARTNER,), (PARTNER,))
ORG_LEGAL_PERSON = Entity("org_legal_person", "partner_org_legal_person", (PARTNER,), (PARTNER,))
POSTAL_ADDRESS = Entity("postal_address", "partner_postal_address", (PARTNER,), (PARTNER,))
COUNTERPARTIES = Entity("counterparty", "partner_counterparty", (COUNTERPARTY,), (COUNTERPARTY,))
ACCOUNTS = Entity("account", "partner_filalkunde", (COUNTERPARTY, SEQUENCE), (COUNTERPARTY,))
SUPPORT = Entity(
    "support", "partner_cust_support", (COUNTERPARTY, SEQUENCE, SUPPORT_UNIT), (COUNTERPARTY,)
)
MANAGERS = Entity(
    "manager",
    "partner_acct_manager",
    ("branch", "acct_mngr_id", "acct_mngr_dept_id", "acct_mngr_area"),
)
MANAGER_PARTS = {
    "branch": "branch",
    "manager": "acct_mngr_id",
    "department": "acct_mngr_dept_id",
    "area": "acct_mngr_area",
}

PERSON_ENTITIES = (NATURAL_PERSON, ORG_LEGAL_PERSON, POSTAL_ADDRESS)
SHORT_CHAIN = (INFO, COUNTERPARTIES, ACCOUNTS, SUPPORT, MANAGERS)
FULL_CHAIN = (INFO, *PERSON_ENTITIES, COUNTERPARTIES, ACCOUNTS, SUPPORT, MANAGERS)
ENTITIES = {entity.name: entity for entity in FULL_CHAIN}

# Which feed fills which entity's table, and the names its columns get there.
ENTITY_FEEDS = {
    "info": "Partner_Info",
    "natural_person": "Partner_Natural_Person",
    "org_legal_person": "Partner_Org_Legal_Person",
    "postal_address": "Partner_Post_Addr",
    "counterparty": "Partner_Counterparty",
    "account": "Partner_Filialkunde",
    "support": "Partner_Cust_Support",
    "manager": "Partner_Acct_Manager",
}
FLATTEN_NAMES = {
    "GESCHPARTID": COUNTERPARTY,
    "IDLFDNR": SEQUENCE,
    "BETREU": UNIT_CODE,
    "FIL": "branch",
    "BETREUNR": "acct_mngr_id",
    "NIEDLNR": "acct_mngr_dept_id",
    "EINSZBER": "acct_mngr_area",
}
