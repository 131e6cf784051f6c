import random

import pytest
from conftest import plan_of, rows

from stammwerk.operators.joins import left_join


@pytest.fixture(scope="module")
def sides(spark):
    random.seed(3)
    keys = [None, *range(12)]
    left = [(random.choice(keys), random.choice([None, 0, 1]), f"l{i}") for i in range(60)]
    # Key 5 holds a good third of all rows.
    right = [
        (5 if i % 3 == 0 else random.choice([*keys, 77]), random.choice([None, 0, 1]), i)
        for i in range(300)
    ]
    return (
        spark.createDataFrame(left, "a int, b int, l string"),
        spark.createDataFrame(right, "ra int, rb int, r int"),
    )


@pytest.mark.parametrize("pairs", [[("a", "ra")], [("a", "ra"), ("b", "rb")]])
def test_protection_does_not_change_the_rows(sides, pairs):
    left, right = sides
    expected = rows(left_join(left, right, pairs))
    assert rows(left_join(left, right, pairs, protect=True)) == expected
    assert sum(r[3] is None for r in expected) > 0


def test_empty_sides(sides):
    left, right = sides
    assert left_join(left.where("false"), right, [("a", "ra")], True).count() == 0
    assert left_join(left, right.where("false"), [("a", "ra")], True).count() == left.count()


def test_a_protected_join_is_an_inner_and_an_anti_join(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(left_join(left, right, [("a", "ra")], protect=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Inner" in plan and "LeftAnti" in plan and "LeftOuter" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
