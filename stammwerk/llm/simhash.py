"""SimHash near-duplicates: fingerprints linked by a binary trie joined with itself.

A fingerprint takes the majority of each bit over the XXH64 hashes of a text's
shingles. Links are pairs of fingerprints that differ in few bits. They are found on
distinct fingerprints only, so any number of equal texts costs one entry.

Two fingerprints within ``distance`` bits of each other agree on ``blocks - distance``
of ``blocks`` bit blocks. For each choice of that many blocks the fingerprints are dealt
out by those blocks' bits, and every group is a binary trie that is traversed together
with itself: a pair of nodes is split bit by bit, its differing bits add up, and it is
given up as soon as they exceed ``distance``. Sorted fingerprints are the trie: a node
is a range of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.components import connected_components
from stammwerk.llm.shared import in_batches, stored, text_bytes, text_key

SHINGLE_WORDS = 4
DISTANCE = 4
BLOCKS = 6
# Fingerprints of one group that a task joins at once; larger groups are dealt out
# as pairs of parts of about this size.
GROUP_SIZE = 200_000
# Node pairs and shingles handled at once within a task.
FRONTIER = 1 << 20
SHINGLES_AT_ONCE = 1 << 16
_SEED = 42


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint; zero for a text without words."""
    words = text_bytes(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words)) - 1
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - k].tolist()
    ends = ends[k:].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array(
            [digest(joined[s:e], _SEED) for s, e in zip(starts[part], ends[part])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(doc_id, text_key, fingerprint as a signed long) of every row."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 2000):
            found = np.array(
                [fingerprint(t.as_py(), shingle_words) for t in batch.column(2)], np.uint64
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found.view(np.int64))],
                names=["doc_id", "text_key", "fp"],
            )

    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def _split(ones: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the one-child of each node begins."""
    return high - (ones[high] - ones[low])


def join_tries(
    values: np.ndarray, pairs: tuple[np.ndarray, ...], distance: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``values`` that differ in at most ``distance`` bits.

    ``pairs`` holds node pairs as (low, high, low, high) ranges, each range sorted. A
    pair of a node with itself stands for the pairs within it.
    """
    ones_at: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in ones_at:
            bits = (values >> np.uint64(bit)) & np.uint64(1)
            ones_at[bit] = np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32)
        return ones_at[bit]

    stack = [(63, np.zeros(len(pairs[0]), np.int8), *pairs)]
    while stack:
        bit, used, l1, h1, l2, h2 = stack.pop()
        # A pair of single fingerprints needs no further splitting.
        single = (h1 - l1 == 1) & (h2 - l2 == 1)
        if single.any():
            i, j = l1[single], l2[single]
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= distance)
            yield i[near], j[near]
            rest = ~single
            used, l1, h1, l2, h2 = used[rest], l1[rest], h1[rest], l2[rest], h2[rest]
        if not len(used) or bit < 0:
            continue
        if len(used) > FRONTIER:
            half = len(used) // 2
            for part in (slice(half), slice(half, None)):
                stack.append((bit, used[part], l1[part], h1[part], l2[part], h2[part]))
            continue
        m1, m2 = _split(ones(bit), l1, h1), _split(ones(bit), l2, h2)
        same = (l1 == l2) & (h1 == h2)
        crossed = (used + 1).astype(np.int8)
        children = [
            (used, l1, m1, l2, m2, None),
            (used, m1, h1, m2, h2, None),
            (crossed, l1, m1, m2, h2, None),
            (crossed, m1, h1, l2, m2, ~same),  # of a node with itself the mirror image
        ]
        kept = []
        for spent, a, b, c, d, allowed in children:
            keep = (b > a) & (d > c) & (spent <= distance)
            if allowed is not None:
                keep &= allowed
            # A single fingerprint paired with itself holds no pair.
            keep &= ~((a == c) & (b == d) & (b - a == 1))
            kept.append([x[keep] for x in (spent, a, b, c, d)])
        stack.append((bit - 1, *(np.concatenate(x) for x in zip(*kept))))


def _tie(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the sets of i and j, element by element, in a forest of stars."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            return
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _spanning_edges(
    part: np.ndarray, side: np.ndarray, fps: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Edges that tie together what is linked within each group of rows.

    Rows are sorted by group number, side and unsigned fingerprint. Rows of side 0
    alone are joined with themselves; with rows of side 1 each side with the other.
    """
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = np.append(starts[1:], len(part))
    ones = np.concatenate([[0], np.cumsum(side)])
    middle = ends - (ones[ends] - ones[starts])
    alone = middle == ends
    l2, h2 = np.where(alone, starts, middle), np.where(alone, middle, ends)
    keep = (middle > starts) & ~(alone & (ends - starts == 1))
    pairs = (starts[keep], middle[keep], l2[keep], h2[keep])
    parent = np.arange(len(fps))
    for i, j in join_tries(fps, pairs, distance):
        _tie(parent, i, j)
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[child], fps[parent[child]]


def _join_groups(distance: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        count = 0

        def flush(columns: list[np.ndarray]) -> pa.RecordBatch:
            key, i, j, side, fp = columns
            change = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            part = np.concatenate([[0], np.cumsum(change)])
            fps = fp.view(np.uint64)
            order = np.lexsort((fps, side, part))
            a, b = _spanning_edges(part[order], side[order], fps[order], distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            count += batch.num_rows
            if count < GROUP_SIZE:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            key, i, j = columns[:3]
            # The last group may go on in the next batch.
            last = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield flush([c[:cut] for c in columns])
            held, count = [[c[cut:] for c in columns]], len(key) - cut
        if count:
            yield flush([np.concatenate(c) for c in zip(*held)])

    return run


def _bit_blocks(blocks: int) -> list[int]:
    """Bit masks of ``blocks`` blocks that make up 64 bits."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    return [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def near_fingerprints(
    fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, group_size: int = GROUP_SIZE
) -> DataFrame:
    """Edges (a, b) of distinct fingerprints ``fp`` that connect all within ``distance``.

    Not every link is listed, but every two linked fingerprints are connected by edges.
    A group larger than ``group_size`` is cut into parts by a hash, and each pair of
    parts becomes a group of its own.
    """
    if blocks <= distance:
        raise ValueError("there must be more blocks than differing bits")
    masks = _bit_blocks(blocks)
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - distance)):
        mask = _signed(sum(chosen))
        keys.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask))))
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = (
        keyed.groupBy("key").count().where(F.col("count") > group_size)
        .select("key", F.ceil(F.col("count") / F.lit(group_size)).cast("int").alias("parts"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        keyed.join(large, "key", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .select("key", "fp", own.alias("own"),
                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select(
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "fp",
        )
    )
    return (
        dealt.repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(_join_groups(distance), "a long, b long")
    )


def _classes(found: DataFrame, distance: int, blocks: int, group_size: int) -> DataFrame:
    """(fp, root, component_id) of the rows of :func:`fingerprints`.

    ``root`` is the class's least fingerprint; classes can share a component_id where
    rows of different texts share an id.
    """
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = near_fingerprints(nodes.select("fp"), distance, blocks, group_size)
    roots = connected_components(edges, "a", "b")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def _classified(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    group_size: int = GROUP_SIZE,
) -> DataFrame:
    """(fp, doc_id, text_key, root, component_id) of every row."""
    found = stored(fingerprints(docs, id_column, text_column, shingle_words), "simhash")
    return found.join(_classes(found, distance, blocks, group_size), "fp")


def simhash_components(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """Each row's fingerprint and near-duplicate class, the smallest id that is reachable.

    Returns (doc_id, text_key, fingerprint, component_id), one row per row of ``docs``.
    Null and wordless texts have fingerprint zero and are linked like others. Rows
    that share an id keep their own fingerprints. A null id never names a class; a class
    of null ids only has a null class id. Other columns, whatever their names, play no
    part. An empty table gives an empty result.
    """
    return _classified(docs, id_column, text_column, **options).select(
        "doc_id",
        "text_key",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """One document of each class, the one with the smallest id; columns as in ``docs``.

    Rows repeated whole count once. Rows without an id cannot be told apart and stay.
    """
    return keep_least(docs, _classified(docs, id_column, text_column, **options), id_column, text_column)


def keep_least(docs: DataFrame, classes: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The row with the smallest id of each ``root`` of ``classes``, and rows without an id."""
    keep = (
        classes.where("doc_id IS NOT NULL")
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "text_key")).alias("kept"))
        .select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.text_key").alias("_kept_text"))
    )
    marked = docs.withColumn("_text_key", text_key(text_column))
    on = (F.col(id_column).cast("long") == F.col("_kept_id")) & (
        F.col("_text_key") == F.col("_kept_text")
    )
    named = (
        marked.where(F.col(id_column).isNotNull())
        .join(keep, on, "left_semi")
        .dropDuplicates([id_column, "_text_key"])
    )
    return named.unionByName(marked.where(F.col(id_column).isNull())).select(docs.columns)
