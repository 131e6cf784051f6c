"""Flatten: entities reduced to current rows and left-joined into one wide table.

The chain is partner - persons - counterparty - account - support - manager. It is
joined as two branches, (partner ... counterparty) and (account, support, manager),
which meet on partner and counterparty. Left joins allow that grouping because each
condition refers only to the input next to it. It keeps the rows that are shuffled
narrow, and partners without an account never pile up under a null account key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from stammwerk.functions.unit_codes import FEED_LAYOUT, UnitLayout, decode_number, decode_unit
from stammwerk.operators.joins import Steps, gathered_left_join, join_condition, left_join
from stammwerk.operators.versions import current_rows
from stammwerk.plans.entities import (
    ACCOUNTS,
    COUNTERPARTIES,
    COUNTERPARTY,
    ENTITIES,
    FLATTEN_NAMES,
    FULL_CHAIN,
    INFO,
    MANAGER_PARTS,
    MANAGERS,
    PARTNER,
    PERSON_ENTITIES,
    SEQUENCE,
    SUPPORT,
    UNIT_CODE,
    Entity,
)
from stammwerk.session import stored

# Tie-break columns by entity name, where they are not the entity's own.
TieBreaks = Mapping[str, Sequence[str]]


def staging_to_flatten(staging: DataFrame, names: Mapping[str, str] = FLATTEN_NAMES) -> DataFrame:
    """Give feed columns the names the flatten step uses."""
    return staging.withColumnsRenamed(dict(names))


def tie_break_of(entity: Entity, rows: DataFrame, tie_breaks: TieBreaks | None) -> Sequence[str] | None:
    """The stated tie-break columns, else those of the entity's own that there are.

    None (all columns) is left only for a table that has none of them.
    """
    if tie_breaks and entity.name in tie_breaks:
        return tie_breaks[entity.name]
    return [c for c in entity.tie_break if c in rows.columns] or None


def current_of(
    entity: Entity, rows: DataFrame, tie_breaks: TieBreaks | None = None, gather_by: Sequence[str] = ()
) -> DataFrame:
    return current_rows(rows, entity.keys, tie_break_of(entity, rows, tie_breaks), gather_by=gather_by)


def current_entities(
    inputs: Mapping[str, DataFrame], tie_breaks: TieBreaks | None = None
) -> dict[str, DataFrame]:
    """The current rows of each entity."""
    return {name: current_of(ENTITIES[name], df, tie_breaks) for name, df in inputs.items()}


def register_current_views(
    inputs: Mapping[str, DataFrame], tie_breaks: TieBreaks | None = None
) -> list[str]:
    """Register each entity's current rows as a temporary view; returns the view names."""
    views = []
    for name, df in current_entities(inputs, tie_breaks).items():
        df.createOrReplaceTempView(ENTITIES[name].view)
        views.append(ENTITIES[name].view)
    return views


def read_entities(
    spark: SparkSession, chain: Sequence[Entity], schema: str | None = None, current: bool = False
) -> dict[str, DataFrame]:
    """The entities' version tables or views by entity name, or their stored current rows."""
    prefix = f"{schema}." if schema else ""
    return {e.name: spark.table(prefix + (e.view if current else e.table)) for e in chain}


def output_names(inputs: Mapping[str, DataFrame], chain: Sequence[Entity]) -> dict[str, dict[str, str]]:
    """Output name of each column by entity.

    A name that several entities carry is prefixed with the entity's name; the
    partner's own id stays as it is.
    """
    carried = [c for entity in chain for c in inputs[entity.name].columns]
    names = {}
    for entity in chain:
        names[entity.name] = {
            c: c
            if carried.count(c) == 1 or (entity is INFO and c == PARTNER)
            else f"{entity.name}_{c}"
            for c in inputs[entity.name].columns
        }
    return names


def flatten(
    inputs: Mapping[str, DataFrame],
    chain: Sequence[Entity] = FULL_CHAIN,
    tie_breaks: TieBreaks | None = None,
    all_versions: bool = False,
    from_current: bool = False,
    layout: UnitLayout = FEED_LAYOUT,
    strict_codes: bool = True,
    protect: Sequence[str] = (),
    gathered: bool = False,
    managers_first: bool = False,
    staged: bool = False,
) -> DataFrame:
    """One wide table from the entities of ``chain``.

    Each input is reduced to current rows first, unless ``all_versions`` is set or the
    inputs are current already (``from_current``, as stored by
    :func:`stammwerk.plans.jobs.write_current_tables`).

    ``protect`` names the entities whose join has keys that own a large part of their
    rows (see :func:`stammwerk.operators.joins.left_join`); "account" is the join of accounts,
    with what hangs on them, to partners. The rows of the result are the same either way.

    ``gathered`` says that accounts can be gathered by counterparty: no counterparty owns a large
    part of accounts or support rows, and stored current rows are bucketed by it. Support rows
    and partners are brought to the accounts, which are not shuffled again with all they carry.
    All versions multiply, so there the partners are joined last. A protected join keeps
    its own shuffles. The rows are the same here, too.

    ``managers_first`` stores the managers' rows before anything is joined, so that Spark knows
    their size: below its threshold for broadcasts support rows are not shuffled for them, above
    it both sides are as without the option.
    """
    unknown = set(protect) - {e.name for e in chain if e is not INFO}
    if unknown:
        raise ValueError(f"no join of {sorted(unknown)} to protect")
    names = output_names(inputs, chain)
    frames = {}
    hot = {ACCOUNTS.name, SUPPORT.name} & set(protect)
    for entity in chain:
        rows = inputs[entity.name]
        together = [COUNTERPARTY] if entity in (ACCOUNTS, SUPPORT) and gathered and not hot else []
        if entity is SUPPORT and gathered and hot == {ACCOUNTS.name}:
            together = [COUNTERPARTY, SEQUENCE]  # as accounts are ranked; no hot counterparty meets
        if not (all_versions or from_current):
            rows = current_of(entity, rows, tie_breaks, together)
        elif all_versions and together and not staged:
            rows = rows.repartition(*together)
        frames[entity.name] = rows.toDF(*names[entity.name].values())
    if managers_first:
        frames[MANAGERS.name] = stored(frames[MANAGERS.name], "managers")

    if staged:
        return _staged(frames, names, chain, all_versions, layout, strict_codes, protect, gathered and not hot)

    def name(entity: Entity, column: str) -> str:
        return names[entity.name][column]

    partner = frames[INFO.name]
    for entity in PERSON_ENTITIES:
        if entity in chain:
            on = [(PARTNER, name(entity, PARTNER))]
            partner = left_join(partner, frames[entity.name], on, entity.name in protect)

    counterparty_of, account_of = name(COUNTERPARTIES, COUNTERPARTY), name(ACCOUNTS, COUNTERPARTY)
    support = _with_managers(frames, names, layout, strict_codes, MANAGERS.name in protect)
    to_support = (account_of, name(SUPPORT, COUNTERPARTY))
    by_sequence = (name(ACCOUNTS, SEQUENCE), name(SUPPORT, SEQUENCE))
    if gathered and not hot:
        account = gathered_left_join(frames[ACCOUNTS.name], support, to_support, [by_sequence])
    else:
        account = left_join(frames[ACCOUNTS.name], support, [to_support, by_sequence], SUPPORT.name in protect)

    counterparty = frames[COUNTERPARTIES.name]
    to_partner = [(PARTNER, name(COUNTERPARTIES, PARTNER))]
    same_partner = (name(COUNTERPARTIES, PARTNER), name(ACCOUNTS, PARTNER))
    if gathered and all_versions:
        if hot:
            on = [same_partner, (counterparty_of, account_of)]
            behind = left_join(counterparty, account, on, ACCOUNTS.name in protect)
        else:
            held = counterparty.repartition(counterparty_of)
            behind = gathered_left_join(held, account, (counterparty_of, account_of), [same_partner])
        wide = left_join(partner, behind, to_partner, COUNTERPARTIES.name in protect)
    else:
        partner = left_join(partner, counterparty, to_partner, COUNTERPARTIES.name in protect)
        if gathered and not hot:
            # Partners without a counterparty are spread by their own id; they find nothing.
            kind = partner.schema[counterparty_of].dataType
            place = F.coalesce(F.col(counterparty_of), F.hash(PARTNER).try_cast(kind))
            partner = partner.withColumn("_place", place).repartition("_place")
            wide = gathered_left_join(partner, account, ("_place", account_of), [same_partner, (counterparty_of, account_of)])
        else:
            to_accounts = [(PARTNER, name(ACCOUNTS, PARTNER)), (counterparty_of, account_of)]
            wide = left_join(partner, account, to_accounts, ACCOUNTS.name in protect)
    return wide.select([n for entity in chain for n in names[entity.name].values()])


def _with_managers(
    frames: Mapping[str, DataFrame],
    names: Mapping[str, Mapping[str, str]],
    layout: UnitLayout,
    strict_codes: bool,
    protect: bool,
) -> DataFrame:
    """Support rows with the manager their packed unit code points to."""
    support = frames[SUPPORT.name]
    parts = decode_unit(F.col(names[SUPPORT.name][UNIT_CODE]), layout, strict_codes)
    decoded = support.withColumns({f"_{part}": column for part, column in parts.items()})
    on = [
        (f"_{part}", names[MANAGERS.name][column]) for part, column in MANAGER_PARTS.items()
    ]
    return left_join(decoded, frames[MANAGERS.name], on, protect).drop(*[left for left, _ in on])


def _staged(
    frames: Mapping[str, DataFrame],
    names: Mapping[str, Mapping[str, str]],
    chain: Sequence[Entity],
    all_versions: bool,
    layout: UnitLayout,
    strict_codes: bool,
    protect: Sequence[str],
    gathered: bool,
) -> DataFrame:
    """The wide table by steps that are stored, partners last."""
    steps = Steps()

    def name(entity: Entity, column: str) -> str:
        return names[entity.name][column]

    support = frames[SUPPORT.name]
    parts = decode_unit(F.col(name(SUPPORT, UNIT_CODE)), layout, strict_codes)
    support = support.withColumns({f"_{part}": column for part, column in parts.items()})
    whole = isinstance(support.schema[name(SUPPORT, UNIT_CODE)].dataType, IntegralType)
    again = decode_number(name(SUPPORT, UNIT_CODE), layout, strict_codes) if whole else parts
    on = [(f"_{part}", name(MANAGERS, column)) for part, column in MANAGER_PARTS.items()]
    if MANAGERS.name in protect:
        support = steps.stored(support, "decoded")
    support = steps.left_join(
        support, frames[MANAGERS.name], on, "_manager_met", MANAGERS.name in protect,
        known_by={f"_{part}": column for part, column in again.items()},
    ).drop(*[lc for lc, _ in on])
    support = steps.stored(support, "support")
    steps.forget(support, "decoded", "_manager_met")

    account = frames[ACCOUNTS.name]
    to_support = (name(ACCOUNTS, COUNTERPARTY), name(SUPPORT, COUNTERPARTY))
    by_sequence = (name(ACCOUNTS, SEQUENCE), name(SUPPORT, SEQUENCE))
    counterparty_of, account_of = name(COUNTERPARTIES, COUNTERPARTY), name(ACCOUNTS, COUNTERPARTY)
    same_partner = (name(COUNTERPARTIES, PARTNER), name(ACCOUNTS, PARTNER))
    to_accounts = [same_partner, (counterparty_of, account_of)]

    partner = frames[INFO.name]
    for entity in PERSON_ENTITIES:
        if entity in chain:
            on = [(PARTNER, name(entity, PARTNER))]
            partner = left_join(partner, frames[entity.name], on, entity.name in protect)
    counterparty = frames[COUNTERPARTIES.name]
    to_partner = [(PARTNER, name(COUNTERPARTIES, PARTNER))]
    if not all_versions:
        partner = steps.left_join(partner, counterparty, to_partner, "_counterparty_met", COUNTERPARTIES.name in protect)
        to_accounts = [(PARTNER, name(ACCOUNTS, PARTNER)), (counterparty_of, account_of)]
    partner = steps.stored(partner, "partner")
    steps.forget(partner, "_counterparty_met")

    if gathered:
        account = steps.left_join(account, support, [by_sequence], "_support_met", gathered=to_support)
    else:
        account = steps.stored(account, "account")
        if not all_versions:
            # Accounts that no partner will meet are not carried any further.
            met = account.join(partner.select(PARTNER, counterparty_of).distinct(), join_condition(to_accounts), "left_semi")
            account = steps.stored(met, "met")
            steps.forget(account, "account")
        keys = account
        account = steps.left_join(account, support, [to_support, by_sequence], "_support_met", SUPPORT.name in protect)
        account = steps.stored(account, "accounts")
        steps.forget(account, "support", "account", "_support_met")

    protected = ACCOUNTS.name in protect
    if not all_versions:
        if gathered:
            wide = steps.left_join(partner, account, to_accounts, "_account_met", protected)
        else:
            wide = steps.left_join(partner, account, to_accounts, "_account_met", protected, keys=keys)
            if protected:
                steps.forget(wide, "partner", "met")
    else:
        if gathered:
            held = counterparty.repartition(counterparty_of)
            behind = steps.left_join(held, account, [same_partner], "_account_met", gathered=(counterparty_of, account_of))
        else:
            behind = steps.left_join(counterparty, account, to_accounts, "_account_met", protected)
        behind = steps.stored(behind, "behind")
        steps.forget(behind, "support", "accounts", "_account_met")
        wide = steps.left_join(partner, behind, to_partner, "_counterparty_met", COUNTERPARTIES.name in protect)
        if COUNTERPARTIES.name in protect:
            steps.forget(wide, "partner")
    return wide.select([steps.shown(n) for entity in chain for n in names[entity.name].values()])
