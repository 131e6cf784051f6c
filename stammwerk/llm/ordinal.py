"""Cumulative-link regression of ordered grades on hashed text features.

P(grade > k | x) = sigmoid(w.x - t_k): one sparse weight vector for all grades, ordered
thresholds t_0 < t_1 < ... The model is fitted on a bounded sample of rated documents, by
proximal gradient steps with an L1 penalty, so that words without influence weigh exactly
nothing and long texts gather no noise. It scores whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import CACHE_WORDS, hashed_share, in_batches, text_bytes, text_key

# Rated documents a model is fitted on at most; which ones, a hash of the id decides.
SAMPLE_ROWS = 4000
# Features are hashed to 2 ** HASH_BITS buckets.
HASH_BITS = 18
ITERATIONS = 150
LEAST_DOCUMENTS = 4
PENALTY = 2e-4


@dataclass
class OrdinalModel:
    """Shared weights by hash bucket, and thresholds between the ``grades``."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int] = field(default_factory=list)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -500, 500)
        return 1 / (1 + np.exp(-z))

    def expected(self, score: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, float))
        return self.grades[0] + self.tails(score) @ steps


class Features(dict):
    """Hash buckets of a word: itself, its beginnings, and its shape."""

    def __init__(self, bits: int = HASH_BITS) -> None:
        super().__init__()
        self.mask = (1 << bits) - 1

    def _bucket(self, kind: bytes, value: bytes) -> int:
        return xxhash.xxh64_intdigest(kind + value) & self.mask

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        lower = word.lower().strip(b".,;:!?\"'()[]")
        letters = sum(c > 127 or chr(c).isalpha() for c in word)
        shape = b"U" if word.isupper() and len(word) > 1 else b"a" if letters == len(word) else b"x"
        tail = bytes(c for c in word[-3:] if c < 128 and not chr(c).isalnum())
        found = [self._bucket(b"w", lower), self._bucket(b"s", shape + tail)]
        found += [self._bucket(b"p", lower[:n]) for n in (4, 5) if len(lower) > n]
        value = tuple(found)
        self[word] = value
        return value

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a text and their weights: how often, damped, for their length."""
        words = text_bytes(text).split()
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        if len(self) > CACHE_WORDS // 4:
            self.clear()
        flat = np.fromiter(
            (b for found in map(self.__getitem__, words) for b in found), np.int64
        )
        # Words said again and again are a feature of their own.
        different = len(set(words)) / len(words)
        spread = self._bucket(b"d", b"%d" % int(10 * different))
        bucket, count = np.unique(flat, return_counts=True)
        value = np.log1p(count) / np.log1p(len(words)) * 3
        return np.append(bucket, spread), np.append(value, 1.0).astype(np.float32)


def feature_rows(
    docs: DataFrame, text_column: str, keep: list[str], bits: int = HASH_BITS
) -> DataFrame:
    """The columns ``keep`` and (buckets, values) of every text."""
    schema = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in in_batches(batches, 500):
            found = [features.counts(t.as_py()) for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)],
                 pa.array([b.astype(np.int32) for b, _ in found], pa.list_(pa.int32())),
                 pa.array([v for _, v in found], pa.list_(pa.float32()))],
                names=[*keep, "buckets", "values"],
            )

    return docs.select(*keep, F.col(text_column).alias("_text")).mapInArrow(
        run, f"{schema}, buckets array<int>, values array<float>"
    )


def fit(
    grade: np.ndarray, rows: np.ndarray, buckets: np.ndarray, values: np.ndarray,
    bits: int = HASH_BITS, iterations: int = ITERATIONS, penalty: float = PENALTY,
    least_documents: int = LEAST_DOCUMENTS,
) -> OrdinalModel:
    """Fit on documents given as (row, bucket, value) triples.

    Without rows, or with one grade only, every text gets that grade (or 0).
    """
    grades = sorted(set(grade.tolist()))
    size = 1 << bits
    if len(grades) < 2:
        return OrdinalModel(np.zeros(size), np.zeros(0), grades or [0])
    n, cuts = len(grade), len(grades) - 1
    seen = np.bincount(buckets, minlength=size)
    frequent = (seen >= least_documents) & (seen < n)
    use = frequent[buckets]
    rows, values = rows[use], values[use].astype(float)
    names, column = np.unique(buckets[use], return_inverse=True)
    above = grade[:, None] > np.array(grades[:-1])[None, :]
    # Each cut's two sides weigh alike, so that rare grades count.
    share = above.mean(axis=0)
    weight = np.where(above, 0.5 / share, 0.5 / (1 - share)) / (n * cuts)
    weights = np.zeros(len(names))
    thresholds = np.linspace(-0.5, 0.5, cuts) if cuts > 1 else np.zeros(1)
    # Lipschitz bound of the gradient by power iteration on X'WX.
    row_weight = weight.sum(axis=1)
    v = np.ones(len(names)) / max(1.0, np.sqrt(len(names)))
    norm = 1.0
    for _ in range(8):
        xv = np.bincount(rows, weights=values * v[column], minlength=n)
        v = np.bincount(column, weights=values * (row_weight * xv)[rows], minlength=len(names))
        norm = float(np.linalg.norm(v)) or 1.0
        v = v / norm
    step = 1 / (0.25 * 1.2 * norm + 0.25 * float(row_weight.sum()))
    ahead_w, ahead_t, pace = weights.copy(), thresholds.copy(), 1.0
    for _ in range(iterations):
        score = np.bincount(rows, weights=values * ahead_w[column], minlength=n)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - ahead_t[None, :], -500, 500)))
        error = (tail - above) * weight
        gradient = np.bincount(
            column, weights=values * error.sum(axis=1)[rows], minlength=len(names)
        )
        stepped = ahead_w - step * gradient
        new_w = np.sign(stepped) * np.maximum(np.abs(stepped) - step * penalty, 0)
        new_t = np.maximum.accumulate(ahead_t + step * error.sum(axis=0))
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead_w = new_w + (pace - 1) / new_pace * (new_w - weights)
        ahead_t = new_t + (pace - 1) / new_pace * (new_t - thresholds)
        weights, thresholds, pace = new_w, new_t, new_pace
    full = np.zeros(size)
    full[names] = weights
    return OrdinalModel(full, thresholds, grades)


def train(
    docs: DataFrame, ratings: DataFrame, grade_column: str, id_column: str = "doc_id",
    text_column: str = "text", sample_rows: int = SAMPLE_ROWS, bits: int = HASH_BITS, **options,
) -> OrdinalModel:
    """Fit on at most ``sample_rows`` rated documents, chosen by a hash of their id.

    The sample is the only thing that reaches the driver. Ratings without an id or a
    grade are left out; of several ratings of a document the lowest counts.
    """
    rated = (
        ratings.where(F.col(id_column).isNotNull() & F.col(grade_column).isNotNull())
        .groupBy(F.col(id_column).alias("_rated_id"))
        .agg(F.min(grade_column).cast("int").alias("_grade"))
    )
    hashed = F.xxhash64("_rated_id")
    few = rated.where(hashed_share(hashed, ratings.count(), 3 * sample_rows))
    chosen = few.orderBy(hashed, "_rated_id").limit(sample_rows)
    texts = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_body"))
    # Bounded by sample_rows rows of two numbers.
    joined = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_rated_id"))
    sample = feature_rows(joined, "_body", ["_grade"], bits).toArrow()
    lists = sample.column("buckets").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if sample.num_rows else np.zeros(0, np.int64)
    return fit(
        sample.column("_grade").to_numpy().astype(np.int64),
        np.repeat(np.arange(sample.num_rows), lengths),
        lists.flatten().to_numpy().astype(np.int64),
        sample.column("values").combine_chunks().flatten().to_numpy(),
        bits, **options,
    )


def score(
    docs: DataFrame, model: OrdinalModel, id_column: str = "doc_id", text_column: str = "text",
    bits: int = HASH_BITS,
) -> DataFrame:
    """(doc_id, text_key, score, expected, tails) of every whole text."""
    used = np.flatnonzero(model.weights)
    held = model.weights[used]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << bits)
        weights[used] = held
        features = Features(bits)
        for batch in in_batches(batches, 1000):
            scores = np.zeros(batch.num_rows)
            for row, text in enumerate(batch.column(2)):
                bucket, value = features.counts(text.as_py())
                scores[row] = weights[bucket] @ value
            tails = model.tails(scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores),
                 pa.array(model.expected(scores)),
                 pa.array(list(tails), pa.list_(pa.float64()))],
                names=["doc_id", "text_key", "score", "expected", "tails"],
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(
        run, "doc_id long, text_key long, score double, expected double, tails array<double>"
    )
