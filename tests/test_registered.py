"""Every registered query against DuckDB on the driver's smallest tables."""

import os

import pytest
from conftest import SF_DIR, plan_of

import __spark_entry__ as entry_module
from checks.compare import difference, open_duckdb
from checks.oracle import oracle_sql
from checks.queries import queries

# The library's own queries; those of the text operators are tested in tests/llm.
QUERIES = queries()
ORACLE = oracle_sql()
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(SF_DIR)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


@needs_data
@pytest.mark.parametrize("name", QUERIES)
def test_equals_duckdb(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(found, duck.execute(ORACLE[name]).df()) is None


@needs_data
def test_protecting_one_join_costs_few_shuffles(spark):
    plain, protected = (
        plan_of(QUERIES[n](spark, SF_DIR)).count("Exchange hashpartitioning")
        for n in ("flatten_full", "flatten_full_spread")
    )
    assert protected <= 2 * plain


@needs_data
def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n.startswith(("feed_", "current_", "flatten_"))]
)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("Cartesian", "NestedLoop", "Python", "CollectLimit"):
        assert word not in plan
