"""Document fingerprints by locally consistent parsing.

A text's code points are parsed into phrases whose borders depend on a few neighbouring
symbols only, so equal substrings are parsed alike wherever they stand, but for their
ends. Runs of one symbol are folded; deterministic coin tossing (where a symbol first
differs from the one before it, and how) shrinks symbols to a handful of labels
among which neighbours differ; a phrase begins at each local maximum of the labels. Phrases
get names by hashing and are parsed again, level by level. A fingerprint is made of the
least of several hashes over the phrase names of some levels, so the share of equal places
in two fingerprints estimates how many phrases their texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import text_key

LEVELS = (2, 3, 4)
SLOTS = 20  # per level, 16 bits each
TOSSES = 4  # 64 bits -> 127 -> 13 -> 7 -> 5 labels at most
CHARS_AT_ONCE = 1 << 19

_SLOT_BYTES = 2 * SLOTS * len(LEVELS)
_RANDOM = np.random.default_rng(8)
_SLOT_FACTORS = _RANDOM.integers(1, 2**63, (max(LEVELS) + 1, SLOTS), dtype=np.uint64) | np.uint64(1)
_ORDER = _RANDOM.integers(1, 2**63, 1 << 12, dtype=np.uint64) | np.uint64(1)
_ONE = np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tossed(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels from the lowest bit in which a symbol differs from the one before it."""
    differing = np.empty_like(x)
    differing[1:] = x[1:] ^ x[:-1]
    differing[starts] = 1  # a text's first symbol is told by its lowest bit
    lowest = differing & (~differing + x.dtype.type(1))
    at = np.bitwise_count(lowest - x.dtype.type(1)).astype(x.dtype)
    return (at << x.dtype.type(1)) | ((x >> at) & x.dtype.type(1))


def _fold_runs(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one symbol; returns symbols and where texts start."""
    new = np.empty(len(x), bool)
    new[0] = True
    np.not_equal(x[1:], x[:-1], out=new[1:])
    new[starts] = True
    at = np.flatnonzero(new)
    if len(at) == len(x):
        return x, starts
    run = np.diff(np.append(at, len(x))).astype(np.uint64)
    symbols = x[at]
    folded = np.where(run > 1, _mix(symbols + run * np.uint64(0x9E3779B97F4A7C15)), symbols)
    return folded, np.searchsorted(at, starts)


def parse_level(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the next level's phrases and where texts start among them."""
    x, starts = _fold_runs(x, starts)
    labels = _tossed(x, starts).astype(np.uint8)
    for _ in range(TOSSES - 1):
        labels = _tossed(labels, starts)
    border = np.zeros(len(x), bool)
    border[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] >= labels[2:])
    # The last symbol of a text never opens a phrase; the first always does.
    border[np.append(starts[1:], len(x)) - 1] = False
    border[starts] = True
    at = np.flatnonzero(border)
    lengths = np.diff(np.append(at, len(x)))
    offset = np.arange(len(x)) - np.repeat(at, lengths)
    weighted = _mix(x) * _ORDER[offset & (len(_ORDER) - 1)]
    names = _mix(np.add.reduceat(weighted, at) + lengths.astype(np.uint64))
    return names, np.searchsorted(at, starts)


def _group_fingerprints(texts: list[str]) -> np.ndarray:
    """One row of slots per non-empty text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    x = points.astype(np.uint64)
    slots = []
    for level in range(1, max(LEVELS) + 1):
        x, starts = parse_level(x, starts)
        if level in LEVELS:
            for factor in _SLOT_FACTORS[level]:
                slots.append(np.minimum.reduceat(x * factor, starts) >> np.uint64(24))
    return np.stack(slots, axis=1).astype("<u2")


def fingerprints(texts: list[str]) -> np.ndarray:
    """len(texts) x slots; an empty text has zeros."""
    found = np.zeros((len(texts), SLOTS * len(LEVELS)), "<u2")
    group: list[int] = []
    size = 0
    for k, text in enumerate([*texts, None]):
        if group and (text is None or size + len(text) > CHARS_AT_ONCE):
            found[group] = _group_fingerprints([texts[g] for g in group])
            group, size = [], 0
        if text:
            group.append(k)
            size += len(text)
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row."""
    return (a == b).mean(axis=-1)


def _edited(text: str, following: str) -> str:
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
           " edited_fingerprint string, near_edited double, near_next double")


def _rows(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Results of all texts but the last, which only follows."""
    own = texts[:-1]
    edited = [_edited(a, b) for a, b in zip(own, texts[1:])]
    found = fingerprints(texts)
    changed = fingerprints(edited)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            pa.array([f.tobytes().hex() for f in found[:-1]]),
            pa.array([f.tobytes().hex() for f in changed]),
            pa.array(likeness(found[:-1], changed)),
            pa.array(likeness(found[:-1], found[1:])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
               "near_edited", "near_next"],
    )


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (bucket, follows, doc_id, text) to results.

    Within a bucket each row's next text is the following row's; the last ones are rows that
    only follow.
    """
    held: tuple | None = None  # the row whose next text is still to come
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        columns = (batch.column(k) for k in range(4))
        for bucket, follows, doc, text in zip(*columns):
            bucket, follows, text = bucket.as_py(), follows.as_py(), text.as_py() or ""
            if held is None or held[0] != bucket:
                if follows:
                    continue  # a repeated row of those that only follow
                held, texts = (bucket, doc.as_py()), [text]
                continue
            ids.append(held[1])
            texts.append(text)
            size += len(text)
            held = None if follows else (bucket, doc.as_py())
            if held is None or size > CHARS_AT_ONCE:
                yield _rows(ids, texts)
                ids, texts, size = [], texts[-1:], 0


def compare_with_next(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Each text's fingerprint next to that of its edited text and of the next document.

    The next document has the next smaller id; after the smallest comes the largest. The
    edited text's last third (rounded down) is replaced by as much of the next
    document's beginning as there is. Returns (doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next).

    Null texts are empty; empty texts have an all-zero fingerprint and are alike. Rows
    with equal ids follow each other in an order their texts decide; rows without an id
    come after all others. A single row is its own next. Other columns play no part; an
    empty table gives an empty result.

    Rows are dealt out by id ranges; what follows the last row of a range is the first row
    of the next one, which is sent to both. Only range bounds and one id per range reach
    the driver, as many as there are partitions.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        order.alias("order"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    shares = [k / n for k in range(1, n)]
    quantiles = keyed.approxQuantile("order", shares, 0.2 / n) if shares else []
    bounds = sorted({int(q) for q in quantiles})
    if bounds:
        above = F.filter(F.lit(bounds), lambda b: b <= F.col("order"))
        bucket = F.size(above)
    else:
        bucket = F.lit(0)
    keyed = keyed.withColumn("bucket", bucket)
    heads = (
        keyed.groupBy("bucket")
        .agg(F.max(F.struct("order", "text_key")).alias("head"))
        .orderBy("bucket")
        .collect()  # a row per range
    )
    # A range is followed by the head of the range below it, the lowest by that of the highest.
    followed = [(heads[(k + 1) % len(heads)].bucket, h.head) for k, h in enumerate(heads)]
    targets = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("follows")))
    if followed:
        by_bucket = F.create_map(*[
            F.lit(x) for h, (target, head) in zip(heads, followed) for x in (h.bucket, target)
        ])
        head_order = F.create_map(*[F.lit(x) for h in heads for x in (h.bucket, h.head.order)])
        head_text = F.create_map(*[F.lit(x) for h in heads for x in (h.bucket, h.head.text_key)])
        is_head = (F.col("order") == head_order[F.col("bucket")]) & (
            F.col("text_key") == head_text[F.col("bucket")]
        )
        also = F.struct(by_bucket[F.col("bucket")].alias("bucket"), F.lit(True).alias("follows"))
        targets = F.when(is_head, F.concat(targets, F.array(also))).otherwise(targets)
    dealt = keyed.select("doc_id", "order", "text_key", "text", F.explode(targets).alias("to"))
    return (
        dealt.select("to.bucket", "to.follows", "doc_id", "text", "order", "text_key")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket", "follows", F.desc("order"), F.desc("text_key"))
        .select("bucket", "follows", "doc_id", "text")
        .mapInArrow(_compare, _RESULT)
    )
