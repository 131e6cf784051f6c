import numpy as np
from conftest import SF_DIR, rows
from odd import LONG, ODD_ROWS, frame, no_docs, odd_docs, prose

from stammwerk.llm.containment import (
    contained_items,
    drop_contaminated,
    plain_words,
    shingle_hashes,
    shingle_set,
    signature,
    size_class,
    window_signatures,
)
from stammwerk.llm.shared import WordHashes


def contained(docs, items, share=0.8):
    """Every document against every item."""
    there = [(d, shingle_set(plain_words(t))) for d, t in docs]
    return {
        (i, d, len(q & s), len(q))
        for i, t in items if i is not None
        for q in [shingle_set(plain_words(t))] if q
        for d, s in there if len(q & s) >= share * len(q)
    }


ITEMS = [
    (1, prose(0, 60)),
    (2, " ".join(LONG.split()[30_000:30_017])),
    (3, " ".join(LONG.split()[100:400])),
    (4, "One, TWO three; four Five six."),
    (5, "one two"),
    (6, ""),
    (7, None),
    (None, prose(0, 60)),
    (1, prose(0, 60)),
    (1, prose(6, 30)),
    (8, prose(888, 50)),
    # Four of five words groups are elsewhere in the text.
    (9, " ".join(LONG.split()[7:40] + LONG.split()[20_000:20_030])),
]


def items(spark):
    return spark.createDataFrame([(i, t, 1.0) for i, t in ITEMS], "item_id long, text string, value double")


def test_odd_documents(spark):
    docs = [*ODD_ROWS, (20, "x one two three four five six y"), (21, prose(0, 50)), (22, prose(0, 45))]
    found = contained_items(frame(spark, docs), items(spark))
    got = [(r.item_id, r.doc_id, r.shared, r.item_shingles) for r in found.collect()]
    assert set(got) == contained(docs, ITEMS)
    assert any(i == 2 for i, *_ in got) and any(i == 4 and d == 20 for i, d, *_ in got)


def test_empty_tables(spark):
    assert contained_items(no_docs(spark), items(spark)).count() == 0
    assert contained_items(odd_docs(spark), items(spark).where("false")).count() == 0


def test_contaminated_documents_go(spark):
    docs = odd_docs(spark)
    kept = drop_contaminated(docs, items(spark))
    bad = {d for _, d, *_ in contained(ODD_ROWS, ITEMS)}
    assert kept.schema == docs.schema
    # The second text under id 6 is clean; of the rows without an id one is clean.
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert texts == {(d, t) for d, t in ODD_ROWS
                     if not contained([(d, t)], ITEMS)} and None in bad
    assert (6, prose(66, 80)) in texts and (None, None) in texts


def test_short_items_in_long_documents(spark):
    """Many items of 5, some of up to 24 words within texts whose windows have many more shingles."""
    short, docs = [], []
    for k in range(240):
        words = prose(f"long {k}", 600).split()
        at, size = 101 + 13 * (k % 30), 5 + k % 20 * (k >= 160)
        docs.append((k, " ".join(words)))
        short.append((k, " ".join(words[at : at + size])))
    shared = [(999, short[0][1])]  # an item given twice, under two ids
    table = spark.createDataFrame(short + shared, "item_id long, text string")
    found = {(r.item_id, r.doc_id, r.shared, r.item_shingles)
             for r in contained_items(frame(spark, docs), table).collect()}
    assert found == contained(docs, short + shared)
    only = table.where("item_id < 160")  # five words each: no windows at all
    assert {r.item_id for r in contained_items(frame(spark, docs), only).collect()} == set(range(160))


def test_windows_cover_the_text():
    cache = WordHashes()
    hashes = shingle_hashes(plain_words(prose(3, 5000)), cache)
    for c, values in window_signatures(hashes, [4, 5, 7, 12]):
        width = 1 << c
        for k in range(values.shape[1]):
            part = hashes[k * width : (k + 2) * width]
            assert (values[:, k] == signature(part)).all()
    assert [size_class(n) for n in (1, 16, 17, 32, 33)] == [4, 4, 5, 5, 6]
    assert len(shingle_hashes([b"a"] * 4, cache)) == 0
    assert np.array_equal(shingle_hashes([b"a"] * 6, cache)[:1], shingle_hashes([b"a"] * 5, cache))


def test_whole_table_against_all_pairs(spark):
    from stammwerk.llm.queries import op3_benchmark_decontamination

    found = op3_benchmark_decontamination(spark, SF_DIR)
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    got = rows(found, "item_id", "doc_id", "shared", "item_shingles")
    assert got == sorted(contained(pairs, bench))
