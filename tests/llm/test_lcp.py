import hashlib

import numpy as np
import pytest
from conftest import SF_DIR
from odd import ODD_ROWS, frame, no_docs, odd_docs, prose

from stammwerk.llm.lcp import CHARS_AT_ONCE, compare_with_next, fingerprints, likeness, parse_level


def names(text, levels):
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    starts = np.zeros(1, np.int64)
    for _ in range(levels):
        x, starts = parse_level(x, starts)
    return x.tolist()


def test_equal_substrings_are_parsed_alike_at_any_offset():
    middle = prose(5, 400)
    for level in (1, 2, 3):
        inner = names(middle, level)
        for left in ("", "x", "some other words before ", prose(6, 37)):
            whole = names(left + middle + " and after", level)
            core = inner[4:-4]
            at = [i for i in range(len(whole)) if whole[i : i + len(core)] == core]
            assert len(at) == 1


def test_phrases_shrink_and_runs_fold():
    text = prose(1, 2000)
    sizes = [len(names(text, k)) for k in range(5)]
    for a, b in zip(sizes, sizes[1:]):
        assert a / 8 < b < a / 1.9
    assert len(names("a" * 10_000, 1)) == 1
    assert names("a" * 10_000, 2) != names("a" * 9_999, 2)


def test_batches_do_not_matter():
    texts = [prose(k, 1 + 13 * k % 97) for k in range(60)] + ["", "a", "\U0001f600", "aaaa", "a" * (CHARS_AT_ONCE + 5)]
    together = fingerprints(texts)
    alone = np.concatenate([fingerprints([t]) for t in texts])
    assert (together == alone).all()
    assert not together[texts.index("")].any()


def test_likeness():
    a, b = prose(1, 900), prose(2, 900)
    near = a[:3000] + b[:200] + a[3000:]
    fa, fb, fn = fingerprints([a, b, near])
    assert likeness(fa, fa) == 1 and likeness(fa, fn) > 0.6 and likeness(fa, fb) < 0.2


def expected(docs):
    order = sorted(docs, key=lambda r: -(1 << 63) if r[0] is None else r[0], reverse=True)
    for (d, t), (_, following) in zip(order, [*order[1:], order[0]]):
        t, following = t or "", following or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + following[:third]
        yield d, len(t), hashlib.sha256(edited.encode()).hexdigest(), edited, following


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_next_documents(spark, partitions):
    docs = [(d, t) for d, t in ODD_ROWS if d is not None]
    unique = list({d: (d, t) for d, t in docs}.values())
    found = compare_with_next(frame(spark, unique), partitions=partitions).toPandas()
    want = {d: rest for d, *rest in expected(unique)}
    assert len(found) == len(unique)
    for r in found.itertuples():
        n, digest, edited, following = want[r.doc_id]
        own, changed, after = fingerprints([dict(unique)[r.doc_id] or "", edited, following])
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert (r.fingerprint, r.edited_fingerprint) == (own.tobytes().hex(), changed.tobytes().hex())
        assert r.near_edited == likeness(own, changed) and r.near_next == likeness(own, after)


def test_odd_documents(spark):
    found = compare_with_next(odd_docs(spark)).toPandas()
    assert len(found) == len(ODD_ROWS)
    by_chars = found.groupby("n_chars").fingerprint.nunique()
    assert by_chars[0] == 1 and found.near_edited.between(0, 1).all()
    assert compare_with_next(no_docs(spark)).count() == 0
    single = compare_with_next(frame(spark, [(7, "abc def")])).first()
    assert single.near_next == 1.0 and single.edited_sha256 == hashlib.sha256(b"abc dab").hexdigest()
    twice = compare_with_next(frame(spark, [(7, "abc def")] * 2)).collect()
    assert [r.near_next for r in twice] == [1.0, 1.0]


def test_whole_table(spark):
    from stammwerk.llm.queries import op8_document_fingerprints

    found = op8_document_fingerprints(spark, SF_DIR).toPandas()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = {d: (n, h) for d, n, h, *_ in expected(docs)}
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found.itertuples()} == want
    texts = dict(docs)
    assert found.groupby(found.doc_id.map(texts)).fingerprint.nunique().max() == 1
    assert (found.near_edited > found.near_next).mean() > 0.95
