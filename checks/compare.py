"""Compare registered queries with DuckDB: ``python -m checks.compare [sf_dir] [name part ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries


def open_duckdb(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        values = frame[column]
        if pd.api.types.is_float_dtype(values) or pd.api.types.is_integer_dtype(values):
            frame[column] = values.astype("float64")
        elif not pd.api.types.is_datetime64_any_dtype(values):
            frame[column] = values.map(lambda v: None if pd.isna(v) else str(v)[:40])
    frame = frame.astype(str).replace({"NaN": "None", "nan": "None", "NaT": "None", "<NA>": "None"})
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(left: pd.DataFrame, right: pd.DataFrame) -> str | None:
    """What differs between two results, row order aside; None if nothing does."""
    if sorted(left.columns) != sorted(right.columns):
        return f"columns {sorted(set(left.columns) ^ set(right.columns))}"
    if len(left) != len(right):
        return f"{len(left)} rows, expected {len(right)}"
    a, b = _normal(left), _normal(right)
    differing = [c for c in a.columns if not a[c].equals(b[c])]
    return f"values of {differing}" if differing else None


def main(sf_dir: str, parts: list[str]) -> int:
    from stammwerk.session import RECOMMENDED_SETTINGS

    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    for key, value in {**RECOMMENDED_SETTINGS, "spark.ui.enabled": "false",
                       "spark.driver.memory": "12g"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_duckdb(sf_dir)
    texts = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        started = time.time()
        try:
            found = query(spark, sf_dir).toPandas()
            took = time.time() - started
            expected = connection.execute(texts[name]).df()
            problem = difference(found, expected)
        except Exception as error:  # report and go on with the next query
            took, problem = time.time() - started, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {took:.2f}s"
              f" {len(found) if problem is None else problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
