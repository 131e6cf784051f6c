import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from odd import frame, no_docs, odd_docs, prose
from pyspark.sql import functions as F

from stammwerk.llm import ranking
from stammwerk.llm.ranking import rank_highest
from stammwerk.llm.resampling import resample, word_list

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def slow_resample(docs, target, ngram=1, buckets=10_000, percent=10, min_words=20):
    def features(text):
        w = slow_words(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets
                for k in range(1, ngram + 1) for i in range(len(w) - k + 1)]

    s = Counter(b for _, t in docs for b in features(t))
    t = Counter(b for x in target for b in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found = features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in found]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(slow_words(text)) >= min_words])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def target_frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_words():
    for text in ("Ab9 c-d_E\x7fé\x80x İ ÀB\x00z", None, "", "  a", "1.5e3"):
        assert [w.decode() for w in word_list(text)] == slow_words(text)


@pytest.mark.parametrize("ngram", [1, 3])
def test_against_brute_force(spark, ngram):
    docs = [(i * 7 % 1000, prose(i, 5 + i % 60)) for i in range(400)]
    target = [prose(i, 50) for i in range(0, 400, 9)]
    found = resample(frame(spark, docs).repartition(7), target_frame(spark, target), ngram=ngram, percent=25)
    assert shown(found) == slow_resample(docs, target, ngram, percent=25)


def test_odd_documents_and_empty_tables(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    target = [None, "", prose(6, 40)]
    found = shown(resample(odd_docs(spark), target_frame(spark, target), percent=60))
    want = slow_resample(rows, target, percent=60)
    # Rows that share an id may have equal scores; then only the ranks as such are certain.
    assert [r[:4] for r in found] == [r[:4] for r in want]
    assert sorted(r[4] for r in found if r[4]) == sorted(r[4] for r in want if r[4])
    assert shown(resample(frame(spark, rows[:3]), target_frame(spark, []))) == slow_resample(rows[:3], [])
    assert shown(resample(no_docs(spark), target_frame(spark, target))) == []


def test_ranks_of_ties_and_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SAMPLES", 50)
    rows = [(i, 5 if i % 3 else i % 40, True) for i in range(600)] + [(7, 5, True)] * 300 + [(None, 5, True), (9, 99, False), (1, None, True), (2, 100, None)]
    df = spark.createDataFrame(rows, "id long, score long, ok boolean").repartition(9)
    found = rank_highest(df, "score", "id", F.lit(500) + 0 * F.count(F.lit(1)), "ok").collect()
    assert len(found) == len(rows)
    able = sorted(((-s, i is None, i or 0) for i, s, ok in rows if ok and s is not None))
    have = sorted((r.rank, -r.score, r.id is None, r.id or 0) for r in found if r.rank)
    assert [h[0] for h in have] == list(range(1, 501)) and [h[1:] for h in have] == able[:500]


def test_segments_are_even_for_one_hot_key(spark):
    rows = [(1, 5, True)] * 4000
    df = spark.createDataFrame(rows, "id long, score long, ok boolean").repartition(8)
    ranked = rank_highest(df, "score", "id", F.count(F.lit(1)), "ok")
    assert sorted(r.rank for r in ranked.collect()) == list(range(1, 4001))
    sizes = [len(x) for x in ranked.select("rank").rdd.glom().collect() if x]
    assert max(sizes) < 1500
