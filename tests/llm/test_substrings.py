import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from odd import ODD_ROWS, frame, no_docs, odd_docs, prose

from stammwerk.llm.shared import text_bytes, words_of
from stammwerk.llm.substrings import Powers, Rolling, anchors_of, merged, remove_repeats, strip_repeats


def kept_words(docs, window=50):
    """Per row the words that stay, window by window."""
    first = {}
    for d, t in docs:
        if d is not None:
            w = words_of(t)
            for i in range(len(w) - window + 1):
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in docs:
        w = words_of(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((len(w), [x for x, g in zip(w, gone) if not g]))
    return out


def expected(docs, window=50):
    return [(d, n, n - len(k), hashlib.sha256(b" ".join(k)).hexdigest())
            for (d, _), (n, k) in zip(docs, kept_words(docs, window))]


def found(frame, **options):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(frame, **options).collect()]


def by_text(rows):
    return sorted(rows, key=str)


def test_odd_documents(spark):
    docs = odd_docs(spark)
    assert by_text(found(docs)) == by_text(expected(ODD_ROWS))
    assert found(no_docs(spark)) == []


@pytest.mark.parametrize("seed", range(4))
def test_shared_passages_against_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [prose(f"p{seed}{k}", n) for k, n in enumerate((49, 50, 51, 60, 90, 200))]
    # Few words and repeated ones make many equal anchors.
    passages.append("a " * 70)
    passages.append("b a a b " * 30)
    docs = []
    for d in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.6 else prose(rng.random(), rng.randint(0, 70))
                 for _ in range(rng.randint(1, 5))]
        docs.append((d // 2 if d % 7 == 0 else d, " ".join(parts)))
    assert by_text(found(frame(spark, docs))) == by_text(expected(docs))


def test_other_windows(spark):
    docs = [(d, " ".join(random.Random(d % 3).choices("ab", k=30 + d))) for d in range(12)]
    got = found(frame(spark, docs), window=6, anchor=2)
    assert by_text(got) == by_text(expected(docs, 6))


def test_stripped_texts(spark):
    docs = odd_docs(spark)
    stripped = strip_repeats(docs)
    assert stripped.schema == docs.schema
    want = []
    for (d, t), (n, kept) in zip(ODD_ROWS, kept_words(ODD_ROWS)):
        # What loses nothing stays as it is, white space included.
        want.append((d, t if len(kept) == n else b" ".join(kept).decode()))
    assert by_text(rows(stripped, "doc_id", "text")) == by_text(want)
    assert strip_repeats(no_docs(spark)).count() == 0


def test_hashes_and_anchors():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 4, 400).astype(np.uint64)
    rolling = Rolling(words, Powers())
    starts = np.arange(391)
    hashes = rolling.of(starts, starts + 10)
    by_words = {}
    for i, h in zip(starts.tolist(), hashes.tolist()):
        assert by_words.setdefault(tuple(words[i : i + 10].tolist()), h) == h
    assert len(set(by_words.values())) == len(by_words)
    place = anchors_of(rolling, 400, 50, 10)
    for i, p in enumerate(place.tolist()):
        inside = hashes[i : i + 41]
        assert p == i + int(np.flatnonzero(inside == inside.min())[-1])


def test_merged():
    starts, ends = merged(np.array([5, 0, 7, 20, 12]), np.array([9, 3, 12, 25, 13]))
    assert (starts.tolist(), ends.tolist()) == ([0, 5, 20], [3, 13, 25])
    assert text_bytes(None) == b""
