import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF_DIR
from odd import frame, no_docs, odd_docs, prose

from stammwerk.llm.ctw import line_of, pack, score_texts, unpack, windows


class SlowTree:
    """The weighted tree by recursion over a dictionary of counts."""

    def __init__(self, lines, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        for line in lines:
            for at in range(len(line)):
                for context, bits, bit in self.steps(line, at):
                    self.counts[context, bits][bit] += 1
                    if context:
                        self.longer[context[1:], bits].add(context)
        self.known = {}

    def steps(self, line, at):
        past = (bytes(self.depth) + line[:at])[-self.depth :] if self.depth else b""
        byte = f"{line[at]:08b}"
        for k in range(8):
            for length in range(self.depth + 1):
                yield past[self.depth - length :], byte[:k], int(byte[k])

    def block(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def weighted(self, node):
        if node not in self.known:
            own = self.block(node)
            if len(node[0]) < self.depth:
                own += math.log(0.5)
                rest = math.log(0.5) + sum(self.weighted((c, node[1])) for c in self.longer[node])
                own = max(own, rest) + math.log1p(math.exp(-abs(own - rest)))
            self.known[node] = own
        return self.known[node]

    def chance(self, past, bits, bit, length=0):
        node = past[self.depth - length :], bits
        if node not in self.counts:
            return None
        a, b = self.counts[node]
        own = ((b if bit else a) + 0.5) / (a + b + 1)
        further = self.chance(past, bits, bit, length + 1) if length < self.depth else None
        if further is None:
            return own
        share = math.exp(math.log(0.5) + self.block(node) - self.weighted(node))
        return share * own + (1 - share) * further

    def score(self, line):
        total = 0.0
        for at in range(len(line)):
            past = (bytes(self.depth) + line[:at])[-self.depth :] if self.depth else b""
            byte = f"{line[at]:08b}"
            for k in range(8):
                total += math.log10(self.chance(past, byte[:k], int(byte[k])) or 0.5)
        return total


def slow_scores(docs, depth):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    lines = [line_of(t) for _, t in docs]
    tokens = [[*line.split(), b"\n"] for line in lines]
    train = [line for line, h in zip(lines, held) if not h]
    tree = SlowTree(train, depth)
    c = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    return [
        (d, h, len(ts), sum(c[t] > 0 for t in ts), n,
         sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), tree.score(line))
        for (d, _), h, ts, line in zip(docs, held, tokens, lines)
    ]


def compare(found, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], r[5], r[6])

    rows = sorted((tuple(r)[:7] for r in found.collect()), key=key)
    assert len(rows) == len(want)
    for have, expected in zip(rows, sorted(want, key=key)):
        assert have[:5] == expected[:5]
        assert have[5:] == pytest.approx(expected[5:], rel=1e-9)


def test_windows():
    line = bytes(range(1, 12))
    for depth in (0, 2, 6):
        padded = bytes(depth) + line
        assert windows(line, depth).tolist() == [
            int.from_bytes(padded[i : i + depth][::-1] + line[i : i + 1], "big") for i in range(len(line))]
    assert line_of(" A\tÄb\x0bC ") == "a Äb c\n".encode() and line_of(None) == b"\n"


def test_packed_integers():
    for values in ([], [0], [5, 5, 9, 2**55], [3, 0, 0, 2**40, 1]):
        assert unpack(pack(np.array(values, np.int64))).tolist() == values


@pytest.mark.parametrize("depth", [0, 2, 5])
def test_against_brute_force(spark, depth):
    docs = [(i, prose(i % 30, 5 + i % 25)) for i in range(60)]
    compare(score_texts(frame(spark, docs).repartition(4), depth=depth), slow_scores(docs, depth))


def test_odd_documents(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect() if len(r.text or "") < 10_000]
    compare(score_texts(frame(spark, rows)), slow_scores(rows, 5))
    assert score_texts(odd_docs(spark), depth=2).count() == odd_docs(spark).count()


def test_nothing_to_learn_from_and_no_rows(spark):
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    rows = [(i, "some words") for i in held]
    found = score_texts(frame(spark, rows)).collect()
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in found)
    assert all(r.score == pytest.approx(88 * math.log10(0.5)) for r in found)
    empty = score_texts(no_docs(spark))
    assert empty.count() == 0 and empty.columns[:7] == [
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_the_chances_of_all_bytes_add_up_to_one():
    tree = SlowTree([line_of(prose(i, 20)) for i in range(10)], 3)
    total = 0.0
    for byte in range(256):
        bits = f"{byte:08b}"
        total += math.prod(tree.chance(b"abc", bits[:k], int(bits[k])) or 0.5 for k in range(8))
    assert total == pytest.approx(1)


def test_held_out_texts_are_coded_better_than_by_bytes_alone(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bits = {}
    for depth in (0, 2, 5):
        rows = score_texts(docs, depth=depth).where("held_out").collect()
        bits[depth] = -sum(r.score for r in rows) / math.log10(2) / sum(r.n_bytes for r in rows)
    assert bits[5] < bits[2] < bits[0] < 8
    assert np.isclose(bits[5], 2.4, atol=0.4)
