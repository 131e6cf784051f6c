"""The wide table over time: one row per stretch in which none of its entities changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.functions.unit_codes import FEED_LAYOUT, UnitLayout, decode_unit
from stammwerk.operators.flatten import TieBreaks, output_names, tie_break_of
from stammwerk.operators.history import VALID_FROM, VALID_TO, interval_left_join, timeline
from stammwerk.plans.entities import (
    ACCOUNTS,
    COUNTERPARTIES,
    COUNTERPARTY,
    FULL_CHAIN,
    INFO,
    MANAGER_PARTS,
    MANAGERS,
    PARTNER,
    PERSON_ENTITIES,
    SEQUENCE,
    SUPPORT,
    SUPPORT_UNIT,
    UNIT_CODE,
    Entity,
)
from stammwerk.session import made_paths, remove, stored_at


def flatten_intervals(
    inputs: Mapping[str, DataFrame],
    chain: Sequence[Entity] = FULL_CHAIN,
    tie_breaks: TieBreaks | None = None,
    layout: UnitLayout = FEED_LAYOUT,
    strict_codes: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """The columns of :func:`stammwerk.operators.flatten.flatten`, with ``valid_from`` and ``valid_to``.

    At any time the rows that are valid then are those the flatten of the versions valid
    then would have. A version is valid until the next one of its entity's key; partners and
    the persons behind them are aligned first, and each further entity of the chain is joined
    to the intervals so far.
    """
    ties = {e.name: tie_break_of(e, inputs[e.name], tie_breaks) for e in chain}
    persons = [e for e in (INFO, *PERSON_ENTITIES) if e in chain]
    before_all = made_paths()
    wide = timeline({e.name: inputs[e.name] for e in persons}, [PARTNER], ties, parts=parts)

    kept = [p for p in made_paths() if p not in before_all]

    def joined(entity: Entity, on: Sequence[tuple[str, str]], path: Sequence[str]) -> DataFrame:
        """The intervals joined to ``entity``; all but the last are stored, so that disk holds the
        shuffles of one join at a time, and what only they were made of is deleted."""
        before = made_paths()
        found = interval_left_join(
            wide, inputs[entity.name], on, path, entity.keys, entity.name, ties[entity.name], parts=parts
        )
        if entity is MANAGERS:
            return found
        where, found = stored_at(found, "intervals")
        for old in [*kept, *(p for p in made_paths() if p not in before and p != where)]:
            remove(found.sparkSession, old)
        kept[:] = [where]
        return found

    def part(entity: Entity, column: str):
        return F.col(f"{entity.name}.{column}")

    path = [PARTNER]
    wide = joined(COUNTERPARTIES, [(PARTNER, PARTNER)], path)
    wide = wide.withColumn("_counterparty", part(COUNTERPARTIES, COUNTERPARTY))
    path = [*path, "_counterparty"]
    wide = joined(ACCOUNTS, [(PARTNER, PARTNER), ("_counterparty", COUNTERPARTY)], path)
    wide = wide.withColumns(
        {"_account_of": part(ACCOUNTS, COUNTERPARTY), "_sequence": part(ACCOUNTS, SEQUENCE)}
    )
    path = [*path, "_account_of", "_sequence"]
    wide = joined(SUPPORT, [("_account_of", COUNTERPARTY), ("_sequence", SEQUENCE)], path)
    decoded = decode_unit(part(SUPPORT, UNIT_CODE), layout, strict_codes)
    wide = wide.withColumns(
        {"_unit": part(SUPPORT, SUPPORT_UNIT)} | {f"_{p}": column for p, column in decoded.items()}
    )
    path = [*path, "_unit"]
    wide = joined(MANAGERS, [(f"_{p}", column) for p, column in MANAGER_PARTS.items()], path)

    names = output_names(inputs, chain)
    shown = [
        # The partner is the intervals' key; the structs of its entities are without it.
        (F.when(F.col(e.name).isNotNull(), F.col(PARTNER)) if e in persons and c == PARTNER else part(e, c)).alias(names[e.name][c])
        for e in chain
        for c in inputs[e.name].columns
    ]
    return wide.select(*shown, VALID_FROM, VALID_TO)
