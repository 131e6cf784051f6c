"""Parts of the packed 13-digit account-manager unit code, as built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

UnitLayout = Mapping[str, tuple[int, int]]

# Code width, and (start, length) of each part, 1-based.
# The feed definitions and the flattening query disagree on which part is
# where; FEED_LAYOUT is the default because its names and columns agree.
UNIT_CODE_WIDTH = 13
FEED_LAYOUT: UnitLayout = {
    "area": (2, 2),
    "manager": (4, 2),
    "branch": (6, 3),
    "department": (9, 3),
}
FLATTEN_LAYOUT: UnitLayout = {
    "branch": (2, 2),
    "manager": (4, 2),
    "department": (6, 3),
    "area": (9, 3),
}


def decode_unit(
    code: Column, layout: UnitLayout = FEED_LAYOUT, strict: bool = True
) -> dict[str, Column]:
    """Integer part columns by part name.

    The code is left-padded with zeros; more than 13 digits are cut to the first
    13. With ``strict`` a part that is no number raises (ANSI mode), otherwise it
    is null.
    """
    padded = F.lpad(code.cast("string"), UNIT_CODE_WIDTH, "0")
    parts = {}
    for part, (start, length) in layout.items():
        digits = F.substring(padded, start, length)
        parts[part] = digits.cast("int") if strict else digits.try_cast("int")
    return parts


def decode_number(code: str, layout: UnitLayout = FEED_LAYOUT, strict: bool = True) -> dict[str, Column]:
    """:func:`decode_unit` of an integer column by division: cheaper where rows are many."""
    other = decode_unit(F.col(code), layout, strict)
    inside = F.col(code).between(0, 10**UNIT_CODE_WIDTH - 1)
    parts = {}
    for part, (start, length) in layout.items():
        behind = 10 ** (UNIT_CODE_WIDTH + 1 - start - length)
        digits = F.expr(f"CAST(CAST(`{code}` AS BIGINT) DIV {behind}L % {10**length}L AS INT)")
        parts[part] = F.when(inside, digits).otherwise(other[part])
    return parts
