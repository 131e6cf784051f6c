import random

import pytest
from conftest import jobs_of, plan_of
from pyspark.sql import functions as F

from stammwerk.operators import history
from stammwerk.operators.history import _dealt, as_of_join, collapse_history, interval_left_join, timeline

SCHEMA = "k long, seq int, TSAEND timestamp, a string, b int, note string"


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, s, t, a, b, n) for k, s, t, a, b, n in rows], SCHEMA.replace("TSAEND timestamp", "TSAEND long")
    ).withColumn("TSAEND", F.timestamp_seconds("TSAEND"))


def versions(seed, keys, per_key, hot=0):
    rng = random.Random(seed)
    rows = []
    for k in keys:
        for _ in range(rng.randint(1, per_key)):
            rows.append((k, rng.randint(0, 1), rng.choice([None, *range(1, 40)]), rng.choice(["x", "y", None]),
                         rng.choice([1, 2, None]), f"n{rng.randint(0, 9)}"))
    for t in range(hot):  # one key with most of the rows, its states in long runs
        rows.append((77, 0, 1000 + t, "x" if t % 97 < 60 else "y", 1, "hot"))
    return rows


def time_key(t):
    return (t is not None, t or 0)


def reduced(rows, key):
    """The version of each key and time that sorts last, nulls lowest."""
    best = {}
    for r in rows:
        at = (key(r), r[2])
        rank = tuple((v is not None, v if v is not None else 0) for i, v in enumerate(r) if i != 2)
        if at not in best or rank > best[at][0]:
            best[at] = (rank, r)
    groups = {}
    for (k, _), (_, r) in best.items():
        groups.setdefault(k, []).append(r)
    return {k: sorted(rs, key=lambda r: time_key(r[2])) for k, rs in groups.items()}


def slow_collapse(rows):
    found = []
    for rs in reduced(rows, lambda r: (r[0], r[1])).values():
        starts = [r for i, r in enumerate(rs) if i == 0 or (r[3], r[4]) != (rs[i - 1][3], rs[i - 1][4])]
        for i, r in enumerate(starts):
            found.append((r[0], r[1], r[3], r[4], r[5], r[2], starts[i + 1][2] if i + 1 < len(starts) else None))
    return sorted(found, key=str)


def seconds(c):
    return F.unix_timestamp(c).cast("long").alias(c)


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("hot", [0, 900])
def test_collapsed_history(spark, parts, hot):
    rows = versions(hot + parts, [None, *range(25)], 12, hot)
    found = collapse_history(frame(spark, rows), ["k", "seq"], ["a", "b"], parts=parts).select(
        "k", "seq", "a", "b", "note", seconds("valid_from"), seconds("valid_to"))
    assert sorted(map(tuple, found.collect()), key=str) == slow_collapse(rows)


def test_a_state_may_last_over_many_ranges(spark):
    rows = [(1, 0, t, "x", 1, "n") for t in range(1, 400)] + [(1, 0, 400, "y", 1, "n"), (2, 0, 1, "x", 1, "n")]
    found = collapse_history(frame(spark, rows), ["k"], ["a", "b"], parts=30).select(
        "k", "a", seconds("valid_from"), seconds("valid_to"))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "x", 1, 400), (1, "y", 400, None), (2, "x", 1, None)]


def test_no_rows(spark):
    none = frame(spark, [])
    assert collapse_history(none, ["k"], ["a"]).count() == 0
    assert timeline({"p": none}, ["k"]).count() == 0
    assert as_of_join(none, none, ["k"], "TSAEND", "v").count() == 0
    some = frame(spark, [(1, 0, 5, "x", 1, "n")])
    assert [r.v for r in as_of_join(some, none, ["k"], "TSAEND", "v").collect()] == [None]


def test_a_hot_key_is_many_tasks_work(spark):
    df = frame(spark, versions(1, range(5), 3, 3000))
    found = collapse_history(df, ["k"], ["a", "b"], parts=20)
    plan = plan_of(found)
    assert "Python" not in plan and "NestedLoop" not in plan
    sizes = [r["count"] for r in _dealt(df, ["k", "TSAEND"], 20).where("k = 77").groupBy("_part").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 600


def slow_timeline(sides):
    groups = {name: reduced(rows, lambda r: r[0]) for name, rows in sides.items()}
    lead = next(iter(sides))
    found = []
    for k in groups[lead]:
        times = sorted({r[2] for g in groups.values() for r in g.get(k, [])}, key=time_key)
        rows = []
        for t in times:
            valid = []
            for g in groups.values():
                past = [r for r in g.get(k, []) if time_key(r[2]) <= time_key(t)]
                valid.append(past[-1][5] + str(past[-1][2]) if past else None)
            rows.append((t, valid))
        for i, (t, valid) in enumerate(rows):
            if valid[0] is not None:
                found.append((k, t, rows[i + 1][0] if i + 1 < len(rows) else None, *valid))
    return sorted(found, key=str)


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_timeline(spark, parts):
    sides = {"p": versions(1, [None, *range(20)], 6, 300), "q": versions(2, range(5, 30), 8, 500),
             "r": versions(3, [None, *range(0, 40, 3)], 4)}
    found = timeline({n: frame(spark, rows) for n, rows in sides.items()}, ["k"], parts=parts)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    shown = found.select("k", seconds("valid_from"), seconds("valid_to"), *[
        F.when(F.col(n).isNotNull(), F.concat(f"{n}.note", F.coalesce(F.unix_timestamp(f"{n}.TSAEND").cast("string"), F.lit("None")))).alias(n)
        for n in sides])
    assert sorted(map(tuple, shown.collect()), key=str) == slow_timeline(sides)


@pytest.mark.parametrize("parts", [1, 30])
def test_as_of_join(spark, parts):
    left, right = versions(5, [None, *range(15)], 9, 200), versions(6, [None, *range(3, 20)], 9, 200)
    found = as_of_join(frame(spark, left), frame(spark, right), ["k"], "TSAEND", "v", parts=parts)
    shown = found.select("k", "seq", seconds("TSAEND"), "a", "b", "note", F.col("v.note").alias("v"),
                         F.unix_timestamp("v.TSAEND").cast("long"))
    want = []
    groups = reduced(right, lambda r: r[0])
    for r in left:
        past = [v for v in groups.get(r[0], []) if time_key(v[2]) <= time_key(r[2])]
        want.append((*r, past[-1][5] if past else None, past[-1][2] if past else None))
    assert sorted(map(tuple, shown.collect()), key=str) == sorted(want, key=str)


END = 10**9


def slow_interval_join(left, right):
    """Each interval against each version, then what is left of the interval."""
    def start(t):
        return -1 if t is None else t

    def end(t):
        return END if t is None else t

    found = []
    valid = []
    for rs in reduced(right, lambda r: (r[0], r[1])).values():
        for i, r in enumerate(rs):
            valid.append((r, start(r[2]), end(rs[i + 1][2]) if i + 1 < len(rs) else END))
    for key, f, t, link in left:
        cuts = []
        for r, rf, rt in valid:
            a, b = max(start(f), rf), min(end(t), rt)
            if link is not None and r[4] == link and a < b:
                found.append((key, a, b, link, r[5] + str(r[:3])))
                cuts.append((a, b))
        at = start(f)
        for a, b in [*sorted(cuts), (end(t), end(t))]:
            if a > at:
                found.append((key, at, a, link, None))
            at = max(at, b)
    return sorted(found, key=str)


@pytest.mark.parametrize("parts, hot", [(1, 0), (3, 0), (40, 0), (30, 300)])
def test_interval_left_join(spark, parts, hot):
    rng = random.Random(parts)
    left = []
    for key in [None, *range(25)]:
        times = sorted(rng.sample(range(0, 60), rng.randint(1, 9)))
        times = [None if rng.random() < 0.2 else times[0], *times[1:]]
        for i, f in enumerate(times):
            t = times[i + 1] if i + 1 < len(times) else rng.choice([None, 70])
            if rng.random() < 0.8:  # some stretches are missing
                left.append((key, f, t, rng.choice([None, 1, 2, 3])))
    right = versions(parts, [None, *range(12)], 8, hot)
    schema = "p long, valid_from long, valid_to long, link int"
    lf = spark.createDataFrame(left, schema)
    rf = spark.createDataFrame(right, SCHEMA.replace("TSAEND timestamp", "TSAEND long"))
    found = interval_left_join(lf, rf, [("link", "b")], ["p"], ["k", "seq"], "v", parts=parts)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    shown = [
        (r.p, -1 if r.valid_from is None else r.valid_from, END if r.valid_to is None else r.valid_to, r.link,
         r.v and r.v.note + str((r.v.k, r.v.seq, r.v.TSAEND)))
        for r in found.collect()
    ]
    assert sorted(shown, key=str) == slow_interval_join(left, right)


def test_interval_join_with_nothing(spark):
    left = spark.createDataFrame([(1, 0, 5, 1)], "p long, valid_from long, valid_to long, link int")
    right = spark.createDataFrame([], SCHEMA.replace("TSAEND timestamp", "TSAEND long"))
    found = interval_left_join(left, right, [("link", "b")], ["p"], ["k"], "v").collect()
    assert [tuple(r) for r in found] == [(1, 0, 5, 1, None)]
    assert interval_left_join(left.limit(0), right, [("link", "b")], ["p"], ["k"], "v").count() == 0


@pytest.mark.parametrize("many", [0, 20, 500])
def test_long_keys_on_both_sides_are_merged(spark, monkeypatch, many):
    monkeypatch.setattr(history, "MANY", many)
    left = [(0, t, t + 1 if t % 7 else t + 2, 1 + t % 2) for t in range(0, 300) if (t - 1) % 7] + [(1, 3, None, 1)]
    right = versions(3, range(4), 5, 0) + [(9, 0, 2 * t, "x", 1 + t % 3 % 2, "long") for t in range(120)]
    lf = spark.createDataFrame(left, "p long, valid_from long, valid_to long, link int")
    rf = spark.createDataFrame(right, SCHEMA.replace("TSAEND timestamp", "TSAEND long"))
    found = interval_left_join(lf, rf, [("link", "b")], ["p"], ["k", "seq"], "v", parts=5)
    shown = [
        (r.p, r.valid_from, END if r.valid_to is None else r.valid_to, r.link,
         r.v and r.v.note + str((r.v.k, r.v.seq, r.v.TSAEND)))
        for r in found.collect()
    ]
    assert sorted(shown, key=str) == slow_interval_join(left, right)


def test_an_interval_join_runs_few_stages(spark):
    left = spark.createDataFrame([(1, 0, 5, 1)], "p long, valid_from long, valid_to long, link int")
    right = frame(spark, versions(1, range(3), 3)).withColumn("TSAEND", F.unix_timestamp("TSAEND"))
    with jobs_of(spark) as jobs:
        interval_left_join(left, right, [("link", "b")], ["p"], ["k"], "v", parts=3).collect()
    stages = {s for j in jobs() for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    assert len(stages) < 60, len(stages)
