"""A few operators once more with compiled code, as sessions have it by default."""

import pytest
from conftest import rows
from test_flatten import EXPECTED, SHOWN, inputs  # noqa: F401

from stammwerk.operators.flatten import flatten
from stammwerk.operators.joins import left_join
from stammwerk.plans.entities import SHORT_CHAIN


@pytest.fixture(autouse=True)
def compiled(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


@pytest.mark.parametrize("protect", [[], ["account"]])
def test_short_chain(inputs, protect):  # noqa: F811
    assert rows(flatten(inputs, SHORT_CHAIN, protect=protect), *SHOWN) == EXPECTED


def test_protected_join(spark):
    left, right = spark.range(20), spark.range(10, 40).selectExpr("id % 15 AS r", "id AS v")
    on = [("id", "r")]
    assert rows(left_join(left, right, on, True)) == rows(left_join(left, right, on))
