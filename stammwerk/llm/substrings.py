"""Substring dedup: passages of many words that an earlier document holds are removed.

Every window of ``window`` consecutive words is hashed by Rabin-Karp: prefix sums of word
hashes times powers of a base, modulo 2**64. To count windows without shuffling each
of them, windows are gathered by anchor: of the shorter word sequences a window holds,
the one with the least hash. Equal windows have equal anchors, and some twenty
consecutive windows share one. A row is one anchor with the range of windows it stands
for (a stretch); its words have a hash of their own.

* Stretches with equal words hold equal windows: all but the first document's are
  repeats as a whole. That settles nearly everything by one count per stretch.
* Where an anchor has stretches with different words, the windows of one
  representative of each are counted one by one.

Repeated windows are merged into maximal intervals of words to remove.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import WordHashes, in_batches, stored, text_bytes, text_key, words_of

WINDOW_WORDS = 50
ANCHOR_WORDS = 10
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            size = len(self.up)
            base, inverse = (np.uint64(pow(b, size, 1 << 64)) for b in (_BASE, _INVERSE))
            self.up = np.concatenate([self.up, self.up * base])
            self.down = np.concatenate([self.down, self.down * inverse])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9FB21C651E98DF25)
    return values ^ (values >> np.uint64(28))


class Rolling:
    """Rabin-Karp hashes of any ranges of one text's words."""

    def __init__(self, hashed: np.ndarray, powers: Powers) -> None:
        powers.reach(len(hashed) + 1)
        self.powers = powers
        sums = np.cumsum(hashed * powers.up[: len(hashed)], dtype=np.uint64)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), sums])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((self.prefix[ends] - self.prefix[starts]) * self.powers.down[starts])


def anchors_of(rolling: Rolling, n: int, window: int, anchor: int) -> np.ndarray:
    """For every window the place of its anchor; of equal hashes the last one counts."""
    starts = np.arange(n - anchor + 1)
    value = rolling.of(starts, starts + anchor)
    place = starts
    span, need = 1, window - anchor + 1
    while span < need:
        shift = min(span, need - span)
        left, right = value[:-shift], value[shift:]
        later = right <= left
        place = np.where(later, place[shift:], place[:-shift])
        value = np.where(later, right, left)
        span += shift
    return place


def stretches(
    docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, text_key, anchor, words, start, windows): the windows by anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers = WordHashes(), Powers()
        for batch in in_batches(batches, 1000):
            out, owners = [], []
            for row, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                if len(words) < window:
                    continue
                rolling = Rolling(cache.of(words), powers)
                place = anchors_of(rolling, len(words), window, anchor)
                first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                last = np.append(first[1:], len(place))
                at = place[first]
                out.append((
                    rolling.of(at, at + anchor).view(np.int64),
                    rolling.of(first, last + window - 1).view(np.int64),
                    first.astype(np.int32),
                    (last - first).astype(np.int32),
                ))
                owners.append(np.full(len(first), row))
            if out:
                owner = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner),
                     *(pa.array(np.concatenate(x)) for x in zip(*out))],
                    names=["doc_id", "text_key", "anchor", "words", "start", "windows"],
                )

    rows = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    return rows.mapInArrow(
        run, "doc_id long, text_key long, anchor long, words long, start int, windows int"
    )


def _window_rows(window: int):
    """Hashes of the windows of chosen stretches of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers = WordHashes(), Powers()
        for batch in in_batches(batches, 200):
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for doc, text, chosen in zip(ids, batch.column(1), batch.column(2).to_pylist()):
                words = words_of(text.as_py())
                rolling = Rolling(cache.of(words), powers)
                counts = np.array([c["windows"] for c in chosen])
                starts = np.repeat([c["start"] for c in chosen], counts)
                offset = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = starts + offset
                out.append((
                    np.full(len(at), doc),
                    np.repeat(np.array([c["anchor"] for c in chosen], np.int64), counts),
                    np.repeat(np.array([c["words"] for c in chosen], np.int64), counts),
                    offset.astype(np.int32),
                    rolling.of(at, at + window).view(np.int64),
                ))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in zip(*out)],
                    names=["doc_id", "anchor", "words", "offset", "window"],
                )

    return run


def _settle(docs: DataFrame, found: DataFrame, window: int, id_column: str, text_column: str) -> DataFrame:
    """(anchor, words, first, repeated) of each kind of stretch that costs words: its first
    document, and which of its windows an earlier document holds in a stretch of another
    kind. Stored, so that the join with all stretches has a shuffle on either side and a
    hot kind can be split."""
    kinds = stored(
        found.groupBy("anchor", "words").agg(
            F.min(F.struct("doc_id", "text_key", "start", "windows")).alias("at"),
            F.max("doc_id").alias("last"),
        ),
        "stretch-kinds",
    )
    several = kinds.groupBy("anchor").count().where("count > 1").select("anchor")
    chosen = (
        kinds.join(several, "anchor", "left_semi")
        .groupBy(F.col("at.doc_id").alias("_id"), F.col("at.text_key").alias("_key"))
        .agg(F.collect_list(F.struct(
            "anchor", "words", F.col("at.start").alias("start"), F.col("at.windows").alias("windows")
        )).alias("chosen"))
    )
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    on = (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key"))
    windows = stored(
        texts.join(chosen, on).select("doc_id", "text", "chosen").mapInArrow(
            _window_rows(window), "doc_id long, anchor long, words long, offset int, window long"
        ),
        "stretch-windows",
    )
    earliest = windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("earliest"))
    repeated = (
        windows.join(earliest, ["anchor", "window"])
        .where("earliest < doc_id")
        .groupBy("anchor", "words")
        .agg(F.collect_set("offset").alias("repeated"))  # at most as many as a stretch has windows
    )
    settled = (
        kinds.select("anchor", "words", F.col("at.doc_id").alias("first"), "last")
        .join(repeated, ["anchor", "words"], "left")
        .where("first < last OR repeated IS NOT NULL")
    )
    return stored(settled.drop("last"), "settled-stretches")


def repeated_intervals(
    docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, text_key, start, end): word ranges that earlier documents hold.

    Ranges lie within one stretch and may touch or overlap.
    """
    found = stored(stretches(docs, window, anchor, id_column, text_column), "stretches")
    kinds = _settle(docs, found, window, id_column, text_column)
    marked = found.join(kinds, ["anchor", "words"]).where("first < doc_id OR repeated IS NOT NULL")
    whole = F.array(F.struct(F.lit(0).alias("low"), (F.col("windows") - 1).alias("high")))
    single = F.transform("repeated", lambda o: F.struct(o.alias("low"), o.alias("high")))
    return marked.select(
        "doc_id", "text_key", "start",
        F.explode(F.when(F.col("first") < F.col("doc_id"), whole).otherwise(single)).alias("r"),
    ).select(
        "doc_id", "text_key",
        (F.col("start") + F.col("r.low")).alias("start"),
        (F.col("start") + F.col("r.high") + window).alias("end"),
    )


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of overlapping or touching ones."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    opens = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[opens], ends[np.append(np.flatnonzero(opens)[1:] - 1, len(ends) - 1)]


def _kept(words: list[bytes], ranges: pa.Scalar) -> list[bytes]:
    """The words outside the ranges; all of them where there are none."""
    if not ranges.is_valid:
        return words
    inner = ranges.values
    starts, ends = merged(inner.field("start").to_numpy(), inner.field("end").to_numpy())
    edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(words)]
    return [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]


def _kept_text(text: pa.Scalar, ranges: pa.Scalar) -> str | None:
    """A text that loses nothing stays as it is, white space included."""
    if not ranges.is_valid:
        return text.as_py()
    return b" ".join(_kept(words_of(text.as_py()), ranges)).decode("utf-8", "surrogatepass")


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_batches(batches, 1000):
        n_words, n_removed, digests = [], [], []
        for text, ranges in zip(batch.column(2), batch.column(3)):
            words = words_of(text.as_py())
            kept = _kept(words, ranges)
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "text_key", "n_words", "n_removed", "kept_sha256"],
        )


def _by_document(docs: DataFrame, window: int, anchor: int, id_column: str, text_column: str) -> DataFrame:
    """(_id, _key, _ranges): the intervals of every document that has some."""
    intervals = repeated_intervals(docs, window, anchor, id_column, text_column)
    return intervals.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct("start", "end")).alias("_ranges")  # bounded by the text's length
    )


def remove_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """What every text loses once passages of earlier documents are removed.

    Returns (doc_id, text_key, n_words, n_removed, kept_sha256), one row per row of
    ``docs``. A word goes if it lies in a window whose words also start in a
    document with a smaller id, judged on the input. Null, empty and short texts lose
    nothing (null counts as no words). Rows without an id neither lose words nor cost
    others theirs; rows that share an id do not count as earlier than each other. Other
    columns play no part; an empty table gives an empty result.
    """
    by_doc = _by_document(docs, window, anchor, id_column, text_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    on = (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key"))
    return rows.join(by_doc, on, "left").select("doc_id", "text_key", "text", "_ranges").mapInArrow(
        _digests, "doc_id long, text_key long, n_words long, n_removed long, kept_sha256 string"
    )


def strip_repeats(
    docs: DataFrame, window: int = WINDOW_WORDS, anchor: int = ANCHOR_WORDS,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs``, texts without the words :func:`remove_repeats` counts."""
    by_doc = _by_document(docs, window, anchor, id_column, text_column)
    on = (F.col(id_column).cast("long") == F.col("_id")) & (text_key(text_column) == F.col("_key"))
    place = docs.columns.index(text_column)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1000):
            columns = batch.columns[:-1]
            texts = [_kept_text(t, r) for t, r in zip(columns[place], batch.columns[-1])]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return docs.join(by_doc, on, "left").select(*docs.columns, "_ranges").mapInArrow(run, docs.schema)
