"""Load metadata columns stamped on every loaded row."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The metadata columns. The last one is added only on request.
BOOK_DATE = "md_book_date"
LOAD_DATE = "md_load_date"
LOAD_USER = "md_load_user"
SOURCE_SYSTEM = "md_source_system"
LOAD_TYPE = "md_load_type"
DEFAULT_FIELDS = (BOOK_DATE, LOAD_DATE, LOAD_USER, SOURCE_SYSTEM)


def load_metadata(
    book_date: date | str,
    source_system: str,
    load_user: str,
    load_type: str | None = None,
    fields: Iterable[str] | None = None,
) -> dict[str, Column]:
    """Metadata columns by name.

    ``fields`` selects among the five known columns, with or without the ``md_``
    prefix; the default is all but the load type. The load date is one value for
    all rows of a load, and the book date is a real date so that it can be a
    partition column.
    """
    known = {
        BOOK_DATE: F.lit(str(book_date)).cast("date"),
        LOAD_DATE: F.current_timestamp(),
        LOAD_USER: F.lit(load_user),
        SOURCE_SYSTEM: F.lit(source_system),
        LOAD_TYPE: F.lit(load_type),
    }
    names = [n if n.startswith("md_") else f"md_{n}" for n in fields or DEFAULT_FIELDS]
    unknown = [n for n in names if n not in known]
    if unknown:
        raise ValueError(f"unknown metadata fields: {unknown}")
    return {n: known[n] for n in names}


def stamp(df: DataFrame, metadata: Mapping[str, Any]) -> DataFrame:
    """Add one column per entry; plain values become literals, columns stay as they are."""
    return df.withColumns({name: F.lit(value) for name, value in metadata.items()})
