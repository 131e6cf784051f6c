import random
from collections import defaultdict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from stammwerk.operators.rollup import cube_sets, roll_up, rollup_sets

GROUPS = ["branch", "dept"]


def rows_of(n, hot=0):
    rng = random.Random(n)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]),
             rng.choice([None, -5, 0, 32768, 10**12, *range(50)]), rng.randint(1, 9)) for _ in range(n)]
    return rows + [(1, "a", k % 5000, 1) for k in range(hot)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "branch int, dept string, partner long, amount long")


def slow(rows, sets):
    found = []
    for s in sets:
        kept = defaultdict(list)
        for r in rows:
            kept[tuple(r[GROUPS.index(g)] if g in s else None for g in GROUPS)].append(r)
        bits = sum(1 << (1 - i) for i, g in enumerate(GROUPS) if g not in s)
        for group, rs in kept.items():
            found.append((*group, bits, len(rs), len({r[2] for r in rs} - {None}), sum(r[3] for r in rs)))
    return sorted(found, key=str)


@pytest.mark.parametrize("sets", [cube_sets(GROUPS), rollup_sets(GROUPS), [["dept"]], [[]]])
@pytest.mark.parametrize("n, hot", [(300, 0), (100, 20_000), (0, 0)])
def test_totals(spark, sets, n, hot):
    rows = rows_of(n, hot)
    found = roll_up(frame(spark, rows), GROUPS, sets, "partner", {"total": F.col("amount")})
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows, sets)


def test_sets_and_plan(spark):
    assert cube_sets(GROUPS) == [["branch", "dept"], ["branch"], ["dept"], []]
    assert rollup_sets(GROUPS) == [["branch", "dept"], ["branch"], []]
    with pytest.raises(ValueError, match="not among"):
        roll_up(frame(spark, []), GROUPS, [["x"]], "partner")
    plan = plan_of(roll_up(frame(spark, rows_of(10)), GROUPS, cube_sets(GROUPS), "partner"))
    assert "Python" not in plan and plan.count("partial_bitmap_construct_agg") == 1


def test_bits_are_neither_shuffled_nor_sorted(spark):
    plan = plan_of(roll_up(frame(spark, rows_of(10)), GROUPS, cube_sets(GROUPS), "partner"))
    above, below = plan.split(" partial_bitmap_construct_agg" if " partial_bitmap" in plan else "partial_bitmap_construct_agg")
    # Between the bits and the rows that are gathered by key there is no other shuffle.
    assert above.count("Exchange") == 1 and "bitmap_or_agg" not in plan
    assert "Exchange hashpartitioning(_range" in below


def test_thinly_spread_keys(spark):
    rows = [(1 + k % 3, "ab"[k % 2], (k % 700) * 10**9 - 3 * 10**11, k % 5) for k in range(2100)]
    found = roll_up(frame(spark, rows), GROUPS, cube_sets(GROUPS), "partner", {"total": F.col("amount")})
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows, cube_sets(GROUPS))
