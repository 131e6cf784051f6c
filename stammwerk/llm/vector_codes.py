"""Vector code compression: product quantisation whose nearest entries a GNAT finds.

A vector is cut into equal parts, and each part is replaced by the index of the nearest
entry of that part's codebook. Entries are trained by rounds of assignment and averaging
on integers, so every machine gets the same codebooks. The nearest entry is searched in a
geometric near-neighbour access tree over the entries: its split points store the range of
distances to the points of every child, and a query's distance to a split point rules out
whole children. A child goes only when it is strictly out of reach, with ranges and
distances rounded outwards; what is left is decided by integer squared distances, ties to
the lower index, so the answer is that of a full search.

Per round one row of sums per task, part and entry is shuffled; the driver holds the
codebooks (parts x entries x part length integers), never vectors beyond the first entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Scaled components stay below this, so that squared distances fit 64 bits.
LARGEST = 1 << 27
SPLITS = 4  # split points of a tree node
LEAF = 3  # points that need no further split
_SLACK = 4e-15  # relative, covers the rounding of a square root and a sum

_SCALED = "vec_id long, label {label}, ints array<int>"


@dataclass(frozen=True)
class Node:
    """Split points and, by [split, child], the range of distances to the child's points."""

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: tuple[Node | np.ndarray, ...]  # an array holds the points of a leaf


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = points - point
    return np.einsum("ij,ij->i", gap, gap)


def build_tree(entries: np.ndarray, points: np.ndarray | None = None) -> Node | np.ndarray:
    """A GNAT over the rows of ``entries`` (or those numbered by ``points``)."""
    if points is None:
        points = np.arange(len(entries))
    if len(points) <= LEAF:
        return points
    splits = [points[0]]
    gaps = [squared(entries[points], entries[points[0]])]
    while len(splits) < min(SPLITS, len(points)):
        least = np.min(gaps, axis=0)
        least[np.isin(points, splits)] = -1
        splits.append(points[int(least.argmax())])
        gaps.append(squared(entries[points], entries[splits[-1]]))
    gaps = np.array(gaps)
    owner = gaps.argmin(axis=0)
    for i, split in enumerate(splits):
        owner[points == split] = i
    distances = np.sqrt(gaps.astype(np.float64))
    low = np.array([[distances[i, owner == j].min() for j in range(len(splits))] for i in range(len(splits))])
    high = np.array([[distances[i, owner == j].max() for j in range(len(splits))] for i in range(len(splits))])
    children = tuple(
        build_tree(entries, points[(owner == j) & (points != split)]) for j, split in enumerate(splits)
    )
    return Node(np.array(splits), low * (1 - _SLACK), high * (1 + _SLACK), children)


def nearest(tree: Node | np.ndarray, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each query's nearest entry, ties to the lower index."""
    best = np.full(len(queries), np.iinfo(np.int64).max)
    index = np.full(len(queries), len(entries))

    def offer(rows: np.ndarray, point: int) -> np.ndarray:
        gap = squared(queries[rows], entries[point])
        closer = (gap < best[rows]) | ((gap == best[rows]) & (point < index[rows]))
        best[rows[closer]] = gap[closer]
        index[rows[closer]] = point
        return gap

    def visit(node: Node | np.ndarray, rows: np.ndarray) -> None:
        if not len(rows):
            return
        if isinstance(node, np.ndarray):
            for point in node:
                offer(rows, int(point))
            return
        alive = np.ones((len(rows), len(node.splits)), bool)
        for i, split in enumerate(node.splits):
            near = np.flatnonzero(alive[:, i])
            distance = np.sqrt(offer(rows[near], int(split)).astype(np.float64))[:, None]
            reach = np.sqrt(best[rows[near]].astype(np.float64))[:, None] * (1 + _SLACK)
            beyond = node.low[i] > (distance * (1 + _SLACK) + reach) * (1 + _SLACK)
            within = node.high[i] < distance * (1 - _SLACK) - reach * (1 + _SLACK)
            alive[near] &= ~(beyond | within)
        for j, child in enumerate(node.children):
            visit(child, rows[alive[:, j]])

    visit(tree, np.arange(len(queries)))
    return index, best


def _scaled(length: int | None) -> Callable:
    """Rows with their scaled integers; null for a vector that is not of ``length``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            keep, ints = [], []
            flat = vectors.values
            numbers = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            usable = np.isfinite(numbers)
            if flat.null_count:
                usable &= ~flat.is_null().to_numpy(zero_copy_only=False)
            starts = vectors.offsets.to_numpy()
            for row, there in enumerate(vectors.is_valid().to_pylist()):
                part = slice(starts[row], starts[row + 1])
                if not there or not usable[part].all():
                    continue
                keep.append(row)
                if length is not None and part.stop - part.start != length:
                    ints.append(None)
                    continue
                scaled = np.floor(numbers[part] * SCALE)
                if len(scaled) and np.abs(scaled).max() >= LARGEST:
                    raise ValueError(f"components of {LARGEST // SCALE} or more are not supported")
                ints.append(scaled.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())),
                 batch.column(1).take(pa.array(keep, pa.int64())),
                 pa.array(ints, pa.list_(pa.int32()))],
                names=["vec_id", "label", "ints"],
            )

    return run


def _matrix(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows that have a vector, and the vectors."""
    ints = batch.column(batch.schema.get_field_index("ints"))
    rows = np.flatnonzero(ints.is_valid().to_numpy(zero_copy_only=False))
    flat = ints.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return rows, flat.reshape(len(rows), length)


def _by_part(vectors: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    width = vectors.shape[1] // parts
    for part in range(parts):
        yield vectors[:, part * width : (part + 1) * width]


def _sums(codebooks: np.ndarray):
    parts, entries, width = codebooks.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build_tree(book) for book in codebooks]
        sums = np.zeros(codebooks.shape, np.int64)
        counts = np.zeros((parts, entries), np.int64)
        for batch in batches:
            _, vectors = _matrix(batch, parts * width)
            for part, slices in enumerate(_by_part(vectors, parts)):
                index, _ = nearest(trees[part], codebooks[part], slices)
                np.add.at(sums[part], index, slices)
                counts[part] += np.bincount(index, minlength=entries)
        part, entry = (x.ravel() for x in np.indices((parts, entries)))
        used = counts.ravel() > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[used], pa.int32()), pa.array(entry[used], pa.int32()),
             pa.array(counts.ravel()[used]),
             pa.array(list(sums.reshape(-1, width)[used]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    return run


def _codes(codebooks: np.ndarray):
    parts, _, width = codebooks.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [build_tree(book) for book in codebooks]
        for batch in batches:
            rows, vectors = _matrix(batch, parts * width)
            codes = np.zeros((len(rows), parts), np.uint8)
            errors = np.zeros(len(rows), np.int64)
            for part, slices in enumerate(_by_part(vectors, parts)):
                index, gap = nearest(trees[part], codebooks[part], slices)
                codes[:, part] = index
                errors += gap
            code: list[str | None] = [None] * batch.num_rows
            error: list[int | None] = [None] * batch.num_rows
            for at, row in enumerate(rows):
                code[row], error[row] = codes[at].tobytes().hex(), int(errors[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def fit_codebooks(scaled: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks [part, entry, position] of a table (vec_id, label, ints).

    They start as the parts of the vectors with the smallest ids (equal ids by their
    components, no id last) and are averaged in ``rounds`` rounds; sums are floored
    divisions of integers, entries nothing is nearest to stay.
    """
    first = scaled.where("ints IS NOT NULL").orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries)
    seeds = np.array([r.ints for r in first.select("ints").collect()], np.int64)
    width = seeds.shape[1] // parts
    books = seeds.reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        summed = (
            scaled.select("ints")
            .mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
            .select("part", "entry", "n", F.posexplode("sums").alias("position", "total"))
            .groupBy("part", "entry", "position")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        )
        for row in summed.collect():
            books[row.part, row.entry, row.position] = int(row.total) // row.n
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable vector.

    ``code`` holds an entry's index per part, two hex digits each, ``error`` the squared
    distances to these entries, ``label_error`` the errors of all rows of the same label
    (null labels are one). Vectors that are null or hold a null, NaN or infinite component
    are left out. All vectors should be as long as the one with the smallest id, a multiple
    of ``parts`` (else an error); others get a null code and error. Components of 32,768 or
    more raise. Rows that repeat an id are all coded. Fewer vectors than entries make smaller
    codebooks, and an empty table, or one without a usable vector, gives an empty result.
    Other columns, whatever their names, play no part.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must fit two hex digits")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    kind = rows.schema["label"].dataType.simpleString()
    usable = F.col("vector").isNotNull() & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    least = rows.where(usable).orderBy(F.asc_nulls_last("vec_id"), "vector").select(F.size("vector").alias("n")).first()
    length = least.n if least else None
    if length is not None and length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    scaled = stored(rows.mapInArrow(_scaled(length), _SCALED.format(label=kind)), "vectors")
    if length is None:
        coded, digest = scaled.selectExpr("vec_id", "label", "'' AS code", "0L AS error"), ""
    else:
        books = fit_codebooks(scaled, parts, entries, rounds)
        digest = books_digest(books)
        coded = stored(
            scaled.mapInArrow(_codes(books), f"vec_id long, label {kind}, code string, error long"), "vector-codes"
        )
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
