"""Sources: SQL text, SQL files, catalog tables and views, and files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the one placeholder feed queries use, quoted or not.
BOUND_DATE = "Prev_Working_date"
_PLACEHOLDER = re.compile(r"'?\{\{\s*" + BOUND_DATE + r"\s*\}\}'?")


def read_source(
    spark: SparkSession,
    sql: str | None = None,
    table: str | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows of a query, a table or view, or files; a query wins over the others."""
    if sql:
        return run_query(spark, sql, args)
    if table:
        return spark.table(table)
    if path:
        return spark.read.format(file_format).load(path)
    raise ValueError("give a query, a table or a path")


def run_query(spark: SparkSession, sql: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query with bound parameters.

    ``{{Prev_Working_date}}`` in the text is taken as the parameter
    ``:Prev_Working_date``; the value is bound, never pasted into the text.
    """
    return spark.sql(_PLACEHOLDER.sub(f":{BOUND_DATE}", sql), args=dict(args or {}))


def read_sql_file(
    spark: SparkSession, path: str, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Run the one query a text file holds."""
    texts = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(texts) != 1 or not texts[0].value.strip():
        raise ValueError(f"{path} must hold one query in one file")
    return run_query(spark, texts[0].value.strip().rstrip(";"), args)
