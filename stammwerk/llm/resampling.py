"""Target-distribution importance resampling: documents that look like a target text.

A document's features are runs of consecutive words, hashed into buckets. The gain of a
bucket is the log ratio of its smoothed shares in the target and in the documents; a
document's weight is the mean gain of its features, looked up in one array. Weights plus
Gumbel noise, drawn from a hash of the id, are the scores, and the highest scores are drawn:
a sample without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.ranking import rank_highest
from stammwerk.llm.shared import CACHE_WORDS, in_batches, stored, text_bytes

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

# Lower-cases A-Z and blanks every ASCII character that is neither a digit nor a letter.
_FOLD = bytes(
    c if c >= 0x80 or chr(c).isdigit() or 0x61 <= c <= 0x7A else c + 0x20 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def word_list(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(_FOLD).split()


class _Buckets(dict):
    """Buckets of features, remembered while a worker meets them again."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        value = zlib.crc32(feature) % self.buckets
        self[feature] = value
        return value

    def of(self, words: list[bytes], ngram: int) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        features = list(words)
        for k in range(2, ngram + 1):
            features += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        return np.fromiter(map(self.__getitem__, features), np.uint32, len(features))


def hashed_features(
    rows: DataFrame, id_column: str, text_column: str, ngram: int = NGRAM, buckets: int = BUCKETS
) -> DataFrame:
    """(doc_id, n_words, features): the buckets of all features, as 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Buckets(buckets)
        for batch in in_batches(batches, 1000):
            sizes, found = [], []
            for text in batch.column(1):
                words = word_list(text.as_py())
                sizes.append(len(words))
                found.append(cache.of(words, ngram).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["doc_id", "n_words", "features"],
            )

    return rows.select(F.col(id_column).cast("long"), F.col(text_column)).mapInArrow(
        run, "doc_id long, n_words long, features binary"
    )


def bucket_counts(hashed: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs; a task sends one row per bucket at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for features in batch.column(0):
                counts += np.bincount(np.frombuffer(features.as_py(), "<u4"), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used])], names=["bucket", "n"]
        )

    parts = hashed.select("features").mapInArrow(run, "bucket int, n long")
    total = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row.bucket] = row.n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of the smoothed shares, by bucket."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((float(t + 1) * float(s_all + buckets)) / (float(s + 1) * float(t_all + buckets))))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """floor(-1000 * ln(-ln(u))) with u from a hash of the id; no id is the empty text."""
    name = "" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(hashed: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) by the array of gains."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights, scores = [], [], []
            for doc_id, features in zip(batch.column(0).to_pylist(), batch.column(2)):
                found = np.frombuffer(features.as_py(), "<u4")
                sizes.append(len(found))
                weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
                scores.append(weights[-1] + gumbel(doc_id, seed))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (sizes, weights, scores))],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return hashed.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    ngram: int = NGRAM,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    ``rank`` numbers the drawn documents by falling score: ``percent`` of those with at least
    ``min_words`` words, rounded down; null for the others. Ties go to the smaller id, rows
    without an id last. Null and empty texts have no features and weight 0. Repeated rows
    count, weigh and are drawn each for itself. An empty target leaves every text its share;
    no documents give an empty result. Other columns, whatever their names, play no part.
    """
    hashed = stored(hashed_features(docs, id_column, text_column, ngram, buckets), "features")
    # The id is not used; any column that is there will do.
    aimed = target.select(F.lit(None).cast("long").alias("doc_id"), F.col(target_text).alias("text"))
    wanted = hashed_features(aimed, "doc_id", "text", ngram, buckets)
    gains = bucket_gains(bucket_counts(hashed, buckets), bucket_counts(wanted, buckets))
    found = scored(hashed, gains, seed).withColumn("_long", F.col("n_words") >= min_words)
    limit = F.floor(F.count(F.lit(1)) * F.lit(percent) / F.lit(100))
    return rank_highest(found, "score", "doc_id", limit, "_long").select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
