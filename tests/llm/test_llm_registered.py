"""Registered queries with SQL against DuckDB; what is registered; the operators' independence."""

import re
from pathlib import Path

import pytest
from conftest import SF_DIR
from checks.compare import difference, open_duckdb

import __spark_entry__ as entry_module
from stammwerk.llm.oracle import oracle_sql
from stammwerk.llm.queries import queries

ROOT = Path(entry_module.__file__).parent


@pytest.mark.parametrize("name", oracle_sql())
def test_equals_duckdb(spark, name):
    found = queries()[name](spark, SF_DIR).toPandas()
    assert difference(found, open_duckdb(SF_DIR).execute(oracle_sql()[name]).df()) is None


def test_all_operators_and_the_pipeline_are_registered():
    names = list(entry_module.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(oracle_sql()) <= set(entry_module.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    for file in [*ROOT.glob("stammwerk/**/*.py"), *ROOT.glob("checks/*.py"), ROOT / "bench.py"]:
        if "llm" not in file.parts:
            assert not re.search(r"^\s*(from|import) .*llm", file.read_text(), re.M), file
