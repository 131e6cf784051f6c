"""Benchmark decontamination: which test items does a document contain?

A size-partitioned MinHash containment search. Items of up to ``EXACT_SHINGLES`` shingles,
too small for MinHash, enter with all their shingles' hashes, and a document is a candidate
if it has any of them. Larger items are partitioned by their number of
shingles, each partition reaching up to a power of two. For every partition a
document is cut into windows twice that long, half overlapping, so that an item and the
window around it are alike in size and their MinHash values agree often however long the
document is. A document is a candidate for an item if any of ``HASHES`` MinHash values
of one of its windows equals the item's. Candidates are verified by exact
containment of the item's shingles in the whole document.

The values of all items go into a bitmap of fixed size that every task gets; document
values outside it are dropped where they arise, the others meet the items in a join. The
more items, the fuller the bitmap and the larger that join; results do not change.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import WordHashes, in_batches, stored, text_key

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
HASHES = 64
LEAST_CLASS = 4  # items of up to 2**4 shingles share the first partition of windows
EXACT_SHINGLES = 16  # items of so many shingles are found by the shingles themselves
EXACT_CLASS = 0
BITMAP_BITS = 23
_CHUNK = 2048  # shingles hashed at once; a power of two

_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_PLAIN = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_MULTIPLIERS = np.random.default_rng(20240601).integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    if text is None:
        return []
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def shingle_set(words: list[bytes], size: int = SHINGLE_WORDS) -> set[bytes]:
    return {b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def shingle_hashes(words: list[bytes], cache: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit hash per shingle, from the hashes of its words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    hashed = cache.of(words)
    n = len(words) - size + 1
    mixed = hashed[:n].copy()
    for k in range(1, size):
        mixed = mixed * _STEP + hashed[k : k + n]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def size_class(shingles: int) -> int:
    return max(LEAST_CLASS, (shingles - 1).bit_length())


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a non-empty set of shingle hashes."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        least = np.minimum(least, (hashes[None, at : at + _CHUNK] * _MULTIPLIERS[:, None]).min(axis=1))
    return least


def window_signatures(hashes: np.ndarray, classes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(class, HASHES x windows) MinHash values of a document's windows."""
    blocks = []
    width = 1 << classes[0]
    for at in range(0, len(hashes), max(_CHUNK, width)):
        part = hashes[at : at + max(_CHUNK, width)]
        values = part[None, :] * _MULTIPLIERS[:, None]
        blocks.append(np.minimum.reduceat(values, np.arange(0, len(part), width), axis=1))
    mins = np.concatenate(blocks, axis=1)
    at = classes[0]
    for c in classes:
        while at < c:
            if mins.shape[1] % 2:
                mins = np.concatenate([mins, mins[:, -1:]], axis=1)
            mins = np.minimum(mins[:, ::2], mins[:, 1::2])
            at += 1
        yield c, (np.minimum(mins[:, :-1], mins[:, 1:]) if mins.shape[1] > 1 else mins)


def _positions(values: np.ndarray, c: int) -> np.ndarray:
    """Places in the bitmap of an array of class ``c``, a row per hash function."""
    rows = np.arange(len(values), dtype=np.uint64)[:, None] * np.uint64(64) + np.uint64(c)
    return ((values ^ (rows * _STEP)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITMAP_BITS)


def _exact_positions(hashes: np.ndarray) -> np.ndarray:
    return _positions(hashes[None, :], EXACT_CLASS)[0]


_VALUES = "class int, hash int, value long, place int"


def _value_rows(c: int, hash_numbers: np.ndarray, values: np.ndarray, places: np.ndarray) -> list:
    return [
        np.full(len(values), c, np.int32), hash_numbers.astype(np.int32),
        values.view(np.int64), places.astype(np.int32),
    ]


def item_values(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, class, hash, value, place) of every item with at least one shingle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in in_batches(batches, 1000):
            ids, columns = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.unique(shingle_hashes(plain_words(text), cache))
                if len(hashes) and len(hashes) <= EXACT_SHINGLES:
                    columns.append(_value_rows(
                        EXACT_CLASS, np.zeros(len(hashes)), hashes,
                        _exact_positions(hashes),
                    ))
                    ids += [item] * len(hashes)
                elif len(hashes):
                    values, c = signature(hashes)[:, None], size_class(len(hashes))
                    columns.append(
                        _value_rows(c, np.arange(HASHES), values[:, 0], _positions(values, c)[:, 0])
                    )
                    ids += [item] * HASHES
            if ids:
                arrays = [pa.array(np.concatenate(x)) for x in zip(*columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), *arrays],
                    names=["item_id", "class", "hash", "value", "place"],
                )

    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    return rows.where("item_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        run, f"item_id long, {_VALUES}"
    )


def _bitmap(values: DataFrame) -> np.ndarray:
    """The items' values as bits; its size does not depend on the number of items."""
    words = (
        values.select(
            F.floor(F.col("place") / 64).cast("int").alias("word"),
            F.expr("shiftleft(1L, place % 64)").alias("bits"),
        )
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .collect()  # at most 2 ** BITMAP_BITS / 64 rows
    )
    packed = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in words:
        packed[row.word] = row.bits
    return np.unpackbits(packed.view(np.uint8), bitorder="little").astype(bool)


def document_values(
    docs: DataFrame, bitmap: np.ndarray, classes: list[int],
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, text_key, class, hash, value) of the documents' windows and single shingles
    found in the bitmap."""
    packed = np.packbits(bitmap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present = np.unpackbits(packed).astype(bool)
        cache = WordHashes()
        windowed = [c for c in classes if c != EXACT_CLASS]
        for batch in in_batches(batches, 1000):
            found, owners = [], []
            for row, text in enumerate(batch.column(2)):
                hashes = shingle_hashes(plain_words(text.as_py()), cache)
                if not len(hashes):
                    continue
                if EXACT_CLASS in classes:
                    places = _exact_positions(hashes)
                    at = np.flatnonzero(present[places.astype(np.intp)])
                    at = at[np.unique(hashes[at], return_index=True)[1]]
                    if len(at):
                        found.append(_value_rows(EXACT_CLASS, np.zeros(len(at)), hashes[at], places[at]))
                        owners.append(np.full(len(at), row))
                for c, values in window_signatures(hashes, windowed) if windowed else ():
                    places = _positions(values, c)
                    i, j = np.nonzero(present[places.astype(np.intp)])
                    if len(i):
                        found.append(_value_rows(c, i, values[i, j], places[i, j]))
                        owners.append(np.full(len(i), row))
            if found:
                owner = pa.array(np.concatenate(owners))
                c, i, v, _ = (pa.array(np.concatenate(x)) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), c, i, v],
                    names=["doc_id", "text_key", "class", "hash", "value"],
                )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, text_key long, class int, hash int, value long")


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_batches(batches, 500):
        out: list[list] = [[], [], [], [], []]
        columns = [batch.column(k) for k in range(4)]
        for doc, key, text, items in zip(*(c.to_pylist() for c in columns)):
            there = shingle_set(plain_words(text))
            for item in items:
                wanted = shingle_set(plain_words(item["text"]))
                row = (doc, key, item["item_id"], len(wanted & there), len(wanted))
                for column, value in zip(out, row):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in out],
            names=["doc_id", "text_key", "item_id", "shared", "item_shingles"],
        )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    containment: float = CONTAINMENT,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of a document and an item of whose shingles it holds at least ``containment``.

    Returns (item_id, doc_id, text_key, shared, item_shingles, containment); counts are
    of different shingles. Words are compared in lower case without punctuation. Items
    with fewer words than a shingle, null texts and null item ids match nothing; a
    document without an id is listed with a null id. A repeated row is listed once;
    items that share an id are each searched for. Empty tables give an empty result.
    Other columns play no part.
    """
    spark = docs.sparkSession
    values = stored(item_values(items, item_id, item_text), "item-values")
    classes = sorted(r[0] for r in values.select("class").distinct().collect())  # at most 64
    pairs = "doc_id long, text_key long, item_id long"
    if not classes:
        candidates = spark.createDataFrame([], pairs)
    else:
        found = document_values(docs, _bitmap(values), classes, doc_id, doc_text)
        candidates = (
            found.join(values.drop("place"), ["class", "hash", "value"])
            .select("doc_id", "text_key", "item_id")
            .distinct()
        )
    texts = (
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
        .where("text IS NOT NULL")
        .distinct()
    )
    wanted = (
        candidates.join(texts, "item_id")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("item_id", "text")).alias("items"))
        .select(F.col("doc_id").alias("_doc_id"), F.col("text_key").alias("_text_key"), "items")
    )
    wanted = stored(wanted, "item-candidates")
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        text_key(doc_text).alias("text_key"),
        F.col(doc_text).alias("text"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_key") == F.col("_text_key"))
    checked = rows.join(wanted, on).select("doc_id", "text_key", "text", "items").mapInArrow(
        _verify, "doc_id long, text_key long, item_id long, shared long, item_shingles long"
    )
    share = F.col("shared") / F.col("item_shingles")
    return (
        checked.where(F.col("shared") >= F.lit(containment) * F.col("item_shingles"))
        .distinct()
        .select("item_id", "doc_id", "text_key", "shared", "item_shingles",
                share.alias("containment"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                      doc_text: str = "text", **options) -> DataFrame:
    """The documents that hold no item; columns as in ``docs``."""
    found = contained_items(docs, items, doc_id=doc_id, doc_text=doc_text, **options)
    bad = found.select(
        F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_text")
    ).distinct()
    on = F.col(doc_id).cast("long").eqNullSafe(F.col("_bad_id")) & (
        text_key(doc_text) == F.col("_bad_text")
    )
    return docs.join(bad, on, "left_anti")
