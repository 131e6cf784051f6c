"""Language-model scores by context-tree weighting over bytes.

A text is its lower-case words joined by single spaces, closed by an end byte. Each byte is
eight binary decisions, the highest bit first; a node is a context (the last 0 to ``DEPTH``
bytes) with the bits of the current byte so far. A node's Krichevsky-Trofimov estimate comes
from how often its bit was 0 and 1 in the training texts. Going up from the longest contexts,
a node's weighted probability is half its own estimate's block probability and half the
product of its longer contexts'; the first part's share, ``beta``, is how much the node's own
estimate counts when a bit is predicted. A prediction mixes the estimates of all contexts on
the path, as deep as training has been: a context never seen leaves its weight to the last one
seen. The code length per byte is the negative logarithm of these predictions.

What is gathered grows with the corpus and stays in tables:

1. Documents are stored with the number of the task that wrote them, a block. Each block sends
   its different words, and its different windows (a byte with its ``DEPTH`` bytes of context),
   with their counts in training texts: words packed by buckets of their hash, windows by
   buckets of their last three bytes of context.
2. A bucket holds whole subtrees. One task adds up its windows and grows the tree down to three
   bytes of context; a bucket's different windows are at most 256 ** (DEPTH - 2) for each
   three bytes.
3. The shorter contexts are aggregations of a table, up to the root and back down.
4. Each bucket predicts its different windows once and sends every block its windows' logarithms.
5. Each block adds up its texts. What a task holds is bounded by its input split.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import in_batches, stored, text_bytes
from stammwerk.session import fresh_path

DEPTH = 5
FOLDS = 5
HELD_OUT = 1
END = b"\n"
SHARED = 3  # bytes of context that a bucket's windows share
BUCKETS = 2048
# Bytes of text, or windows, that wait before they are added up.
_CHUNK = 1 << 23

_TEXTS = "doc_id long, held_out boolean, line binary"
_ITEMS = "block long, bucket int, words binary, windows binary, counts binary"
_WORDS = "bucket int, words binary, counts binary, n long, different long"
_WORD_ANSWERS = "block long, words binary, counts binary"
_GROWN = "bucket int, windows binary, counts binary, key long, n0 double, n1 double, weighted double, wanted boolean"
_ANSWERS = "block long, windows binary, logs binary"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long"
_GOLDEN = 2654435761


def line_of(text: str | None) -> bytes:
    """Lower-case words (A-Z only) joined by a space, and the end."""
    return b" ".join(text_bytes(text).lower().split()) + END


def windows(line: bytes, depth: int) -> np.ndarray:
    """Each byte, in the lowest eight bits, with the ``depth`` bytes before it above, the
    nearest on top; zeros before the start."""
    at = np.frombuffer(line, np.uint8).astype(np.int64)
    found = at.copy()
    for back in range(1, min(depth + 1, len(line))):
        found[back:] |= at[:-back] << (8 * (depth + 1 - back))
    return found


def tokens_of(line: bytes) -> list[bytes]:
    """Words, then the end."""
    return [*line.split(), END]


def pack(values: np.ndarray) -> bytes:
    """Rising integers, or small ones, as their differences, equal bytes together."""
    steps = np.diff(values, prepend=0).astype("<i8")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    columns = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(columns.T).view("<i8").ravel())


def pack_words(words: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(words), 1)


def unpack_words(packed: bytes) -> list[bytes]:
    return zlib.decompress(packed).split(b" ")


def _hundreds(values: list) -> Iterator[list]:
    for at in range(0, len(values), 100):
        yield values[at : at + 100]


def added_up(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, place = np.unique(found, return_inverse=True)
    return different, np.bincount(place, counts, len(different)).astype(np.int64)


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_batches(batches, 1000):
        lines = pa.array([line_of(t.as_py()) for t in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lines],
                                         names=["doc_id", "held_out", "line"])


def _shared_level(depth: int) -> int:
    return min(SHARED, depth)


def _buckets(found: np.ndarray, depth: int) -> np.ndarray:
    context = found >> (8 * (depth + 1 - _shared_level(depth)))
    return ((context * _GOLDEN) >> 16) % BUCKETS


class _Items:
    """The different words and windows of one block with their counts in training texts."""

    def __init__(self, depth: int):
        self.depth = depth
        self.words: Counter[bytes] = Counter()
        self.windows = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, line: bytes, held_out: bool) -> None:
        if held_out:
            for word in set(tokens_of(line)):
                self.words.setdefault(word, 0)
        else:
            self.words.update(tokens_of(line))
        # One bit more tells windows of training texts from others while they wait.
        self.waiting.append(windows(line, self.depth) << 1 | int(not held_out))
        self.size += len(line)
        if self.size >= _CHUNK:
            self.settle()

    def settle(self) -> None:
        marked, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        self.windows, self.counts = added_up(
            np.concatenate([self.windows, marked >> 1]), np.concatenate([self.counts, n * (marked & 1)])
        )
        self.waiting, self.size = [], 0

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        self.settle()
        dealt: dict[int, list[bytes]] = {}
        for word in self.words:
            dealt.setdefault(zlib.crc32(word) % BUCKETS, []).append(word)
        for some in _hundreds(list(dealt.items())):
            yield _rows(
                _ITEMS, len(some), block=block, bucket=[b for b, _ in some],
                words=[pack_words(words) for _, words in some],
                counts=[pack(np.array([self.words[w] for w in words])) for _, words in some],
            )
        buckets = _buckets(self.windows, self.depth)
        order = np.argsort(buckets, kind="stable")
        cuts = np.flatnonzero(np.diff(buckets[order], prepend=-1, append=-1))
        parts = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for some in _hundreds(parts):
            yield _rows(
                _ITEMS, len(some), block=block, bucket=[int(buckets[p[0]]) for p in some],
                windows=[pack(self.windows[p]) for p in some], counts=[pack(self.counts[p]) for p in some],
            )


_TYPES = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _rows(schema: str, size: int, **columns) -> pa.RecordBatch:
    """A batch of the named columns; one value stands for all rows, other columns are null."""
    arrays, names = [], []
    for field in schema.split(", "):
        name, kind = field.split()
        value = columns.get(name)
        if value is None:
            array = pa.nulls(size, _TYPES[kind])
        elif isinstance(value, (list, np.ndarray)):
            array = pa.array(value, _TYPES[kind])
        else:
            array = pa.array([value] * size, _TYPES[kind])
        arrays.append(array)
        names.append(name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _items(depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task may read rows of several blocks, or a part of one.
        held: tuple[int, _Items] | None = None
        for batch in batches:
            for line, held_out, block in zip(*(batch.column(k).to_pylist() for k in ("line", "held_out", "block"))):
                if held is None or held[0] != block:
                    if held:
                        yield from held[1].batches(held[0])
                    held = block, _Items(depth)
                held[1].add(line, held_out)
        if held:
            yield from held[1].batches(held[0])

    return run


# --- long contexts, by bucket ----------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma(x) for x > 0, by Stirling's series from 8 on."""
    small = x < 8
    y = np.where(small, x + 8, x)
    value = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi)
    value += 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    low = x[small]
    product = low.copy()
    for i in range(1, 8):
        product *= low + i
    value[small] -= np.log(product)
    return value


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def _bit_keys(found: np.ndarray, depth: int, level: int, bit: int) -> np.ndarray:
    """The node of each window's context of ``level`` bytes at one of the eight bits."""
    context = found >> (8 * (depth + 1 - level))
    return context << 8 | 1 << bit | (found & 255) >> (8 - bit)


def _shorter_keys(keys: np.ndarray) -> np.ndarray:
    return keys >> 16 << 8 | keys & 255


class _Level:
    """The nodes of one length of context, sorted."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, longer: np.ndarray | None = None):
        self.keys, place = np.unique(keys, return_inverse=True)
        self.n0 = np.bincount(place, n0, len(self.keys))
        self.n1 = np.bincount(place, n1, len(self.keys))
        own = log_kt(self.n0, self.n1)
        if longer is None:
            self.weighted, self.beta = own, np.ones(len(own))
        else:
            own += math.log(0.5)
            self.weighted = np.logaddexp(own, math.log(0.5) + np.bincount(place, longer, len(self.keys)))
            self.beta = np.exp(own - self.weighted)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``keys``, and whether they are there."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return at, (self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool))


def grow(found: np.ndarray, counts: np.ndarray, depth: int) -> list[_Level]:
    """Levels from the longest contexts down to those a bucket shares."""
    known, n = found[counts > 0], counts[counts > 0].astype(np.float64)
    keys = [_bit_keys(known, depth, depth, b) for b in range(8)]
    ones = [n * (known >> (7 - b) & 1) for b in range(8)]
    levels = [_Level(np.concatenate(keys), np.concatenate([n - x for x in ones]), np.concatenate(ones))]
    for _ in range(depth - _shared_level(depth)):
        last = levels[-1]
        levels.append(_Level(_shorter_keys(last.keys), last.n0, last.n1, last.weighted))
    return levels


def _slices(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Runs of rows with equal values of the columns, by which the rows are sorted."""
    for batch in batches:
        values = [batch.column(c).to_numpy() for c in columns]
        steps = np.zeros(batch.num_rows, bool)
        for v in values:
            steps |= np.diff(v, prepend=v[:1]) != 0
        cuts = [0, *np.flatnonzero(steps), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield tuple(int(v[a]) for v in values), batch.slice(a, b - a)


def _grown(depth: int):
    """Each bucket's different windows, its nodes of shared contexts, and the shorter nodes
    that windows without those ask for."""

    def finish(bucket: int, found: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield _rows(_GROWN, 1, bucket=bucket, windows=[pack(found)], counts=[pack(counts)])
        top = grow(found, counts, depth)[-1]
        yield _rows(_GROWN, len(top.keys), bucket=bucket, key=top.keys, n0=top.n0, n1=top.n1, weighted=top.weighted)
        if _shared_level(depth):
            keys = np.unique(np.concatenate([_bit_keys(found, depth, _shared_level(depth), b) for b in range(8)]))
            wanted = np.unique(_shorter_keys(keys[~top.find(keys)[1]]))
            yield _rows(_GROWN, len(wanted), bucket=bucket, key=wanted, wanted=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, size = None, [], 0

        def settled() -> tuple[np.ndarray, np.ndarray]:
            return added_up(*(np.concatenate(x) for x in zip(*waiting)))

        for (bucket,), rows in _slices(batches, "bucket"):
            if bucket != held:
                if waiting:
                    yield from finish(held, *settled())
                held, waiting, size = bucket, [], 0
            for some, counts in zip(rows.column("windows"), rows.column("counts")):
                waiting.append((unpack(some.as_py()), unpack(counts.as_py())))
                size += len(waiting[-1][0])
                if size > _CHUNK:
                    waiting = [settled()]
                    # What is left may be large itself; wait for as much again.
                    size = 0
        if waiting:
            yield from finish(held, *settled())

    return run


def window_logs(
    found: np.ndarray, counts: np.ndarray, depth: int, carried: tuple[np.ndarray, ...], shorter: tuple[np.ndarray, ...]
) -> np.ndarray:
    """log10 of the chance of each window's byte after its context.

    ``carried`` holds, for the nodes of shared contexts, the weight that shorter contexts
    leave and what they add to the chance of a 1; ``shorter`` the chance of a 1 at shorter
    nodes.
    """
    levels = grow(found, counts, depth)[::-1]
    order = np.argsort(carried[0])
    rest, mixed = carried[1][order], carried[2][order]
    ones = []
    for k, level in enumerate(levels):
        if k:
            above, _ = levels[k - 1].find(_shorter_keys(level.keys))
            rest, mixed = rest[above], mixed[above]
        kt = (level.n1 + 0.5) / (level.n0 + level.n1 + 1.0)
        ones.append(mixed + rest * kt)
        mixed, rest = mixed + rest * level.beta * kt, rest * (1 - level.beta)
    order = np.argsort(shorter[0])
    short_keys, short_ones = shorter[0][order], shorter[1][order]
    logs = np.zeros(len(found))
    for bit in range(8):
        one = np.full(len(found), np.nan)
        for k in range(len(levels) - 1, -1, -1):
            open_ = np.flatnonzero(np.isnan(one))
            at, there = levels[k].find(_bit_keys(found[open_], depth, depth - (len(levels) - 1 - k), bit))
            one[open_[there]] = ones[k][at[there]]
        open_ = np.flatnonzero(np.isnan(one))
        if len(open_) and len(short_keys):
            keys = _shorter_keys(_bit_keys(found[open_], depth, _shared_level(depth), bit))
            one[open_] = short_ones[np.searchsorted(short_keys, keys)]
        one[np.isnan(one)] = 0.5
        logs += np.log10(np.where(found >> (7 - bit) & 1, one, 1 - one))
    return logs


_SUMS, _CARRIED, _SHORTER, _ASKED = range(4)


def _answers(depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for (bucket, kind), rows in _slices(batches, "bucket", "kind"):
            if bucket != held:
                held, logs = bucket, None
                told: dict[int, list[tuple[np.ndarray, ...]]] = {_CARRIED: [], _SHORTER: []}
            if kind == _SUMS:
                found = unpack(rows.column("windows")[0].as_py())
                counts = unpack(rows.column("counts")[0].as_py())
            elif kind in told:
                told[kind].append(tuple(rows.column(c).to_numpy() for c in ("key", "x", "y")))
            else:
                if logs is None:
                    none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
                    logs = window_logs(
                        found, counts, depth,
                        *(tuple(map(np.concatenate, zip(none, *told[k]))) for k in (_CARRIED, _SHORTER)),
                    )
                asked = rows.column("windows")
                answers = [logs[np.searchsorted(found, unpack(w.as_py()))].tobytes() for w in asked]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("block"), asked, pa.array(answers, pa.binary())], names=["block", "windows", "logs"]
                )

    return run


# --- words ---------------------------------------------------------------------


def _word_sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each bucket's different words with their counts in all training texts."""
    held, sums = None, Counter()

    def finish() -> pa.RecordBatch:
        counts = np.array(list(sums.values()))
        return _rows(
            _WORDS, 1, bucket=held, words=[pack_words(list(sums))], counts=[pack(counts)],
            n=int(counts.sum()), different=int((counts > 0).sum()),
        )

    for (bucket,), rows in _slices(batches, "bucket"):
        if bucket != held:
            if held is not None:
                yield finish()
            held, sums = bucket, Counter()
        for words, counts in zip(rows.column("words"), rows.column("counts")):
            for word, n in zip(unpack_words(words.as_py()), unpack(counts.as_py()).tolist()):
                sums[word] += n
    if held is not None:
        yield finish()


def _word_answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every block's words with their counts in all training texts."""
    for (_, kind), rows in _slices(batches, "bucket", "kind"):
        if kind == _SUMS:
            sums = dict(zip(unpack_words(rows.column("words")[0].as_py()), unpack(rows.column("counts")[0].as_py())))
        else:
            asked = rows.column("words")
            counts = [pack(np.array([sums[w] for w in unpack_words(words.as_py())])) for words in asked]
            yield pa.RecordBatch.from_arrays(
                [rows.column("block"), asked, pa.array(counts, pa.binary())], names=["block", "words", "counts"]
            )


def word_answers(items: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, words, counts), and how many training tokens there are, in all and different."""
    asked = items.where("words IS NOT NULL")
    dealt = asked.select("bucket", "words", "counts").repartition("bucket").sortWithinPartitions("bucket")
    sums = stored(dealt.mapInArrow(_word_sums, _WORDS), "word-sums")
    total, different = sums.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("different"), F.lit(0))
    ).first()
    told = sums.select("bucket", F.lit(_SUMS).alias("kind"), F.lit(None).cast("long").alias("block"), "words", "counts")
    asking = asked.select("bucket", F.lit(_ASKED).alias("kind"), "block", "words", F.lit(None).cast("binary").alias("counts"))
    both = told.union(asking).repartition("bucket").sortWithinPartitions("bucket", "kind")
    return both.mapInArrow(_word_answers, _WORD_ANSWERS), total, different


# --- short contexts, as tables ---------------------------------------------------


def _log_gamma(x: Column) -> Column:
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    y = F.when(x < 8, x + 8).otherwise(x)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    value = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series
    return value - F.when(x < 8, F.log(product)).otherwise(0.0)


def _log_kt() -> Column:
    n0, n1 = F.col("n0"), F.col("n1")
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


_SHORTER_KEY = "shiftleft(shiftright(key, 16), 8) | (key & 255)"


def shorter_levels(nodes: DataFrame, level: int) -> list[DataFrame]:
    """(key, n0, n1, weighted, beta) of all shorter contexts, the empty one first."""
    levels: list[DataFrame] = []
    half = F.lit(math.log(0.5))
    for length in range(level - 1, -1, -1):
        nodes = stored(
            nodes.groupBy(F.expr(_SHORTER_KEY).alias("key"))
            .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("longer"))
            .withColumn("own", half + _log_kt())
            .withColumn("longer", half + F.col("longer"))
            .withColumn("most", F.greatest("own", "longer"))
            .withColumn(
                "weighted",
                F.col("most") + F.log(F.exp(F.col("own") - F.col("most")) + F.exp(F.col("longer") - F.col("most"))),
            )
            .select("key", "n0", "n1", "weighted", F.exp(F.col("own") - F.col("weighted")).alias("beta")),
            f"tree-{length}",
        )
        levels.insert(0, nodes)
    return levels


def _passed_on(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """The nodes with what shorter contexts leave and add (``rest`` and ``mixed``)."""
    if above is None:
        return nodes.withColumn("rest", F.lit(1.0)).withColumn("mixed", F.lit(0.0))
    carried = above.select(
        F.col("key").alias("_above"),
        (F.col("rest") * (1 - F.col("beta"))).alias("rest"),
        (F.col("mixed") + F.col("rest") * F.col("beta") * F.col("kt")).alias("mixed"),
    )
    return nodes.join(carried, F.expr(_SHORTER_KEY) == F.col("_above")).drop("_above")


def paths_down(levels: list[DataFrame]) -> list[DataFrame]:
    """Per level (key, kt, beta, rest, mixed), from the empty context on."""
    paths: list[DataFrame] = []
    for level, nodes in enumerate(levels):
        own = nodes.select("key", ((F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)).alias("kt"), "beta")
        paths.append(stored(_passed_on(own, paths[-1] if paths else None), f"path-{level}"))
    return paths


def chances(wanted: DataFrame, paths: list[DataFrame]) -> DataFrame:
    """(bucket, key, one) of wanted nodes: the chance of a 1 at the deepest node seen."""
    found = wanted.select("bucket", "key", F.col("key").alias("_at"), F.lit(None).cast("double").alias("one"))
    for path in reversed(paths):
        there = path.select(F.col("key").alias("_key"), (F.col("mixed") + F.col("rest") * F.col("kt")).alias("_one"))
        found = found.join(there, F.col("_at") == F.col("_key"), "left").select(
            "bucket", "key",
            F.expr(_SHORTER_KEY.replace("key", "_at")).alias("_at"),
            F.coalesce("one", "_one").alias("one"),
        )
    return found.select("bucket", "key", F.coalesce("one", F.lit(0.5)).alias("one"))


# --- scores --------------------------------------------------------------------


def _scored(total: int, different: int, depth: int):
    """Scores of a block's texts, which come after all answers to the block."""
    below = total + 0.5 * (different + 1)
    unknown = float(np.log10(0.5 / below))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for (block, kind), rows in _slices(batches, "block", "kind"):
            if block != held:
                held, told, base = block, [], {}
                keys = logs = np.zeros(0)
            if kind == _ASKED:
                if told:
                    keys = np.concatenate([k for k, _ in told])
                    order = np.argsort(keys)
                    keys, logs, told = keys[order], np.concatenate([x for _, x in told])[order], []
                yield _scores(rows, base, unknown, keys, logs, depth)
                continue
            for words, counts, some, x in zip(*(rows.column(c).to_pylist() for c in ("words", "counts", "windows", "logs"))):
                if words is not None:
                    base.update(zip(unpack_words(words), np.log10((unpack(counts) + 0.5) / below).tolist()))
                else:
                    told.append((unpack(some), np.frombuffer(x)))

    return run


def _scores(
    rows: pa.RecordBatch, base: dict[bytes, float], unknown: float, keys: np.ndarray, logs: np.ndarray, depth: int
) -> pa.RecordBatch:
    columns: list[list] = [[], [], [], [], []]
    for line in rows.column("line").to_pylist():
        values = list(map(base.__getitem__, tokens_of(line)))
        found = windows(line, depth)
        found.sort()
        columns[0].append(len(values))
        columns[1].append(len(values) - values.count(unknown))
        columns[2].append(math.fsum(values))
        columns[3].append(float(logs[np.searchsorted(keys, found)].sum()))
        columns[4].append(len(line))
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), rows.column("held_out"), *(pa.array(c, pa.int64()) for c in columns[:2]),
         *(pa.array(c, pa.float64()) for c in columns[2:4]), pa.array(columns[4], pa.int64())],
        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_bytes"],
    )


def _window_answers(items: DataFrame, depth: int) -> DataFrame:
    """(block, windows, logs) for every packed list of windows a block has sent."""
    asked = items.where("windows IS NOT NULL")
    dealt = asked.select("bucket", "windows", "counts").repartition("bucket").sortWithinPartitions("bucket")
    grown = stored(dealt.mapInArrow(_grown(depth), _GROWN), "subtrees")
    nodes = grown.where("key IS NOT NULL AND wanted IS NULL")
    levels = shorter_levels(nodes, _shared_level(depth))
    paths = paths_down(levels)
    carried = _passed_on(nodes.select("bucket", "key"), paths[-1] if paths else None)
    shorter = chances(grown.where("wanted"), paths)

    def told(rows: DataFrame, kind: int, **columns: str) -> DataFrame:
        names = {"block": "long", "windows": "binary", "counts": "binary", "key": "long", "x": "double", "y": "double"}
        shown = [
            (F.col(columns[c]) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in names.items()
        ]
        return rows.select("bucket", F.lit(kind).alias("kind"), *shown)

    everything = (
        told(grown.where("windows IS NOT NULL"), _SUMS, windows="windows", counts="counts")
        .union(told(carried, _CARRIED, key="key", x="rest", y="mixed"))
        .union(told(shorter.withColumn("none", F.lit(0.0)), _SHORTER, key="key", x="one", y="none"))
        .union(told(asked, _ASKED, block="block", windows="windows"))
    )
    dealt = everything.repartition("bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(_answers(depth), _ANSWERS)


def score_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", depth: int = DEPTH,
    folds: int = FOLDS, held_out: int = HELD_OUT,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte).

    The model learns from the rows whose CRC32 of the id, as text, modulo ``folds`` is not
    ``held_out``; it stays as it is while texts are scored. ``base_score`` is that of
    smoothed word counts, ``score`` the context tree's, both log10 of the probability of the
    whole text, ``bits_per_byte`` the code length. Null and empty texts are just an end. A
    null id counts as the empty text. Repeated rows learn and are scored each for itself. If
    nothing is learned from, every bit has an even chance. An empty table gives an empty
    result. Other columns, whatever their names, play no part.
    """
    if not 0 <= depth <= 6:
        raise ValueError("a context has 0 to 6 bytes")
    fold = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), (fold == held_out).alias("held_out"),
        F.col(text_column).alias("text"),
    )
    lines = rows.mapInArrow(_lines, _TEXTS).withColumn("block", F.spark_partition_id().cast("long"))
    path = fresh_path(docs.sparkSession, "lines")
    lines.write.option("compression", "zstd").parquet(path)
    texts = docs.sparkSession.read.schema(lines.schema).parquet(path)
    items = stored(texts.mapInArrow(_items(depth), _ITEMS), "items")

    # Where several tasks read parts of one block, it gets some answers twice, which does no harm.
    of_words, total, different = word_answers(items)
    answers = of_words.unionByName(_window_answers(items, depth), allowMissingColumns=True)
    # Blocks are numbered from 0: each is one partition, its answers before its texts.
    blocks = texts.agg(F.max("block")).first()[0]
    both = answers.withColumn("kind", F.lit(_SUMS)).unionByName(
        texts.withColumn("kind", F.lit(_ASKED)), allowMissingColumns=True
    )
    dealt = both.repartitionById((blocks or 0) + 1, F.col("block").cast("int")).sortWithinPartitions("block", "kind")
    found = dealt.mapInArrow(_scored(total, different, depth), _SCORES)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score",
        "score", "n_bytes", (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"),
    )
