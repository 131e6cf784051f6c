import hashlib
import random

import numpy as np
import pytest

from stammwerk.llm.vector_codes import build_tree, compress_vectors, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, code string, part int, ints string, error double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1, "y", 2.0) for i, v, k in rows], SCHEMA)


def vectors(n, length=16, seed=0):
    rng = random.Random(seed)
    return [(i * 3, [round(rng.gauss(0, 1), 2) for _ in range(length)], rng.choice([None, 1, 2])) for i in range(n)]


def by_brute_force(rows, parts=8, entries=16, rounds=6):
    """The contract word for word, with Python's integers."""
    usable = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    usable = [(i, [int(np.floor(np.float32(x) * 4096.0)) for x in v], k) for i, v, k in usable]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(usable[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in usable]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign(p, x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(assign(p, c[p])[0], []).append(c[p])
            for e, xs in members.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for (i, _, k), c in zip(usable, cut):
        found = [assign(p, c[p]) for p in range(parts)]
        coded.append((i, k, "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)))
    total = {}
    for _, k, _, d in coded:
        total[k] = total.get(k, 0) + d
    return sorted((i, code, d, total[k], digest) for i, k, code, d in coded)


def found(df):
    return sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("entries, length, spread", [(16, 8, 4000), (16, 3, 3), (256, 4, 60), (5, 1, 2), (1, 2, 9), (40, 2, 0)])
def test_the_tree_equals_a_full_search(entries, length, spread):
    rng = np.random.default_rng(entries * length)
    points = rng.integers(-spread, spread + 1, (entries, length))
    queries = np.vstack([rng.integers(-spread, spread + 1, (500, length)), points, points[:1] * 10**6])
    index, gap = nearest(build_tree(points), points, queries)
    gaps = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    assert (index == gaps.argmin(axis=1)).all() and (gap == gaps.min(axis=1)).all()


def test_the_tree_rules_out_children():
    rng = np.random.default_rng(1)
    points = rng.integers(-10, 10, (256, 4)) + rng.integers(0, 4, (256, 1)) * 10_000
    seen = []
    tree = build_tree(points)
    import stammwerk.llm.vector_codes as module

    plain = module.squared
    module.squared = lambda a, b: seen.append(len(a)) or plain(a, b)
    try:
        nearest(tree, points, points + 1)
    finally:
        module.squared = plain
    assert sum(seen) < 0.5 * 256 * 256


def test_against_brute_force(spark):
    rows = vectors(300)
    assert found(compress_vectors(frame(spark, rows).repartition(5))) == by_brute_force(rows)


def test_ties_repeated_rows_and_unusable_vectors(spark):
    rows = [(i, [float(i % 3)] * 8, i % 2) for i in range(40)]
    rows += [(7, [1.0] * 8, 1), (7, [1.0] * 8, 1), (3, [-5.0] * 8, None), (100, None, 1),
             (101, [1.0, None] + [0.0] * 6, 1), (102, [float("nan")] * 8, 1), (103, [float("inf")] + [0.0] * 7, 0)]
    assert found(compress_vectors(frame(spark, rows).repartition(3))) == by_brute_force(rows)


def test_null_ids_other_lengths_and_large_components(spark):
    rows = [*vectors(20), (None, [0.5] * 16, 1), (500, [1.0] * 24, 2), (501, [], None)]
    coded = {r.vec_id: r for r in compress_vectors(frame(spark, rows)).collect()}
    assert len(coded) == 23 and coded[None].code is not None
    assert coded[500].code is None and coded[501].error is None and coded[500].label_error is not None
    with pytest.raises(ValueError, match="equal parts"):
        compress_vectors(frame(spark, [(1, [1.0] * 9, 1)]))
    with pytest.raises(Exception, match="not supported"):
        compress_vectors(frame(spark, [(1, [1e9] * 8, 1)])).collect()


def test_small_and_empty_tables(spark):
    rows = vectors(3)
    assert found(compress_vectors(frame(spark, rows))) == by_brute_force(rows)
    for none in ([], [(1, None, 1)], [(2, [None] * 8, 1)]):
        empty = compress_vectors(frame(spark, none))
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0


def test_a_hot_label_in_many_partitions(spark):
    rows = [(i, v, 1) for i, v, _ in vectors(400, 8, 5)]
    assert found(compress_vectors(frame(spark, rows).repartition(50))) == by_brute_force(rows)
