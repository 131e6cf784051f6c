"""Feed specifications: what to take from which hub and satellite."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

INITIAL = "initial"
DELTA = "delta"


@dataclass(frozen=True)
class FeedSpec:
    """One extract: hub joined to satellite, filtered, one version per hub hash key."""

    name: str
    hub: str
    satellite: str
    key: str
    hub_columns: tuple[str, ...]
    satellite_columns: tuple[str, ...]
    equals: Mapping[str, object] = field(default_factory=dict)
    # Satellite column with the packed unit code, and output names of its parts.
    unit_code: str | None = None
    unit_names: Mapping[str, str] = field(default_factory=dict)
    # Ranking columns; the first is the change date, the second must be set in an
    # initial load.
    version_columns: tuple[str, ...] = ("TSAEND", "SYS_START", "SYS_END")
    tie_break: str = "MD_HDIFF_ATTRIBUTES"
    # True skips reducing the hub to one row per hash key before the join.
    hub_is_unique: bool = False

    @property
    def change_date(self) -> str:
        return self.version_columns[0]

    @property
    def loaded_at(self) -> str:
        return self.version_columns[1]


def check_load_type(load_type: str) -> str:
    if load_type not in (INITIAL, DELTA):
        raise ValueError(f"load type must be {INITIAL!r} or {DELTA!r}, not {load_type!r}")
    return load_type


# The nine feeds with their source tables and columns.
NINE_FEEDS = {
    feed.name: feed
    for feed in (
        FeedSpec(
            "Partner_Info",
            hub="partner_partner_h",
            satellite="partner_partner_s",
            key="MD_HKEY_PARTNER_ID",
            hub_columns=("PARTID",),
            satellite_columns=("MANDANT", "EROEFFZTPKTPART", "PARTKLS"),
        ),
        FeedSpec(
            "Partner_Natural_Person",
            hub="partner_partner_h",
            satellite="partner_natural_partner_person_s",
            key="MD_HKEY_PARTNER_ID",
            hub_columns=("PARTID",),
            satellite_columns=("MANDANT", "STANG", "GEBDAT"),
        ),
        FeedSpec(
            "Partner_Org_Legal_Person",
            hub="partner_partner_h",
            satellite="partner_organisation_legal_person_s",
            key="MD_HKEY_PARTNER_ID",
            hub_columns=("PARTID",),
            satellite_columns=("MANDANT", "GRDGDAT"),
        ),
        FeedSpec(
            "Partner_Post_Addr",
            hub="partner_postal_address_h",
            satellite="partner_postal_address_s",
            key="MD_HKEY_POSTAL_ADDRESS_ID",
            hub_columns=("PARTID", "ADRNR"),
            satellite_columns=("LANDBEZGPOSTADR",),
            equals={"ADRNR": 0},
        ),
        FeedSpec(
            "Partner_Counterparty",
            hub="partner_gesch_partner_h",
            satellite="partner_gesch_partner_s",
            key="MD_HKEY_GESCH_PARTNER_ID",
            hub_columns=("GESCHPARTID",),
            satellite_columns=("PARTID", "GESCHPARTKLS", "EROEFFZTPKTGESCHP"),
        ),
        FeedSpec(
            "Partner_Filialkunde",
            hub="partner_filialkunde_h",
            satellite="partner_filialkunde_s",
            key="MD_HKEY_FILIALKUNDE_ID",
            hub_columns=("GESCHPARTID", "IDLFDNR"),
            satellite_columns=(
                "PARTID",
                "FILKDELFDNR",
                "FILKDESTOCKREGI",
                "GESCHBERMERK",
                "Brand",
                "Kea",
                "MANDANT",
                "EROEFFZTPKTFILKDE",
                "FILKDESCHLSZTPKT",
                "segkss",
                "zielgrukss",
                "TEILZIELGRUKSS",
            ),
        ),
        FeedSpec(
            "Partner_Acct_Manager",
            hub="partner_account_manager_h",
            satellite="partner_account_manager_s",
            key="MD_HKEY_ACCOUNT_MANAGER_ID",
            hub_columns=("FIL", "BETREUNR", "NIEDLNR", "EINSZBER"),
            satellite_columns=("ERTRAGSTELLE", "MANDANT"),
        ),
        FeedSpec(
            "Partner_Cust_Support",
            hub="partner_customer_support_h",
            satellite="partner_customer_support_s",
            key="MD_HKEY_CUSTOMER_SUPPORT_ID",
            hub_columns=("GESCHPARTID", "IDLFDNR", "BETREUEINHID"),
            satellite_columns=("BETREU", "BETREUART"),
            equals={"BETREUART": 2},
            unit_code="BETREU",
            unit_names={
                "area": "Cast_EINSZBER",
                "manager": "CAST_BETREUNR",
                "branch": "CAST_FIL",
                "department": "CAST_NIEDLNR",
            },
        ),
        FeedSpec(
            "Partner_Industry",
            hub="partner_branch_classification_h",
            satellite="partner_branch_classification_s",
            key="MD_HKEY_BRANCH_CLASSIFICATION_ID",
            hub_columns=("PARTID",),
            satellite_columns=("BRAZUORDBRAGRU", "BRAZUORDBRA", "BRAPROZ", "HPTBRA"),
            equals={"HPTBRA": 1},
        ),
    )
}
