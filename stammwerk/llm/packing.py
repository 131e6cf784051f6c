"""Best-fit packing of tokenized documents into sequences, improved by local search.

Documents are tokenized in Spark; what is stored of them is one row per piece. Pieces are
dealt out evenly into groups of about ``group_pieces`` and each group is packed in one
task, so a task's work is bounded and a lost one is simply run again. A group loses at
most about one sequence against packing all at once.

Within a group, pieces go largest first into the fullest sequence that has room. Then
local search empties sequences, the least filled one first: one or two of its pieces are moved,
or exchanged for one or two of another sequence with room left. Each step makes a fuller
sequence fuller, so the sum of squared fills rises, until the sequence is empty or no exchange
lowers it. All exchanges count: what sequences can give is kept in a table by total length.
The search ends when there are as few sequences as tokens need, or when every sequence with room
has been tried and none could be emptied.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import in_batches, stored, text_key

SEQUENCE_TOKENS = 2048
END_OF_TEXT = 0
VOCABULARY = "byte_bpe_50k.json"
# Pieces packed together in one task.
GROUP_PIECES = 100_000


def default_vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


class Encoder:
    """Token ids of the byte-level vocabulary ``path`` (``.json``, or ``.tiktoken`` ranks).

    The two files hold one vocabulary and give equal ids; ranks are several times faster,
    so they are used where they lie beside the ``.json`` file. The added tokens of the
    ``.json`` file are matched inside texts by both; ranks without that file have none.
    """

    def __init__(self, path: str) -> None:
        ranks = path.removesuffix(".json") + ".tiktoken" if path.endswith(".json") else path
        try:
            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        except FileNotFoundError:
            table = None
        if table is not None:
            import tiktoken

            added = _plain_added_tokens(path) if path.endswith(".json") else {}
        if table is not None and added is not None:
            self._ranks = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=added
            )
            self.encode = self._by_ranks
        else:
            from tokenizers import Tokenizer

            self._merges = Tokenizer.from_file(path)
            self.encode = self._by_merges

    def _by_ranks(self, text: str) -> list[int]:
        return self._ranks.encode(text, allowed_special="all")

    def _by_merges(self, text: str) -> list[int]:
        return self._merges.encode(text, add_special_tokens=False).ids


def _plain_added_tokens(path: str) -> dict[str, int] | None:
    """Added tokens of a ``.json`` vocabulary; None if they are matched by more than their text."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if any(t.get(x) for t in added for x in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    return {t["content"]: t["id"] for t in added}


def piece_lengths(n: int, limit: int) -> list[int]:
    """Whole pieces of ``limit`` tokens, before them what is over."""
    over = n % limit
    return [over] * (over > 0) + [limit] * (n // limit)


def tokenized_pieces(
    docs: DataFrame,
    limit: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, text_key, piece, start, length, ids_crc32[, ids]) of every document.

    A document is its text's ids and a final ``END_OF_TEXT``; a null text is empty.
    ``vocabulary`` is a path every executor can open.
    """
    path = vocabulary or default_vocabulary()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in in_batches(batches, 1000):
            owners, rows, ids = [], [], []
            for row, text in enumerate(batch.column(2)):
                found = encoder.encode(text.as_py() or "")
                found.append(END_OF_TEXT)
                tokens = np.array(found, "<u4")
                start = 0
                for piece, length in enumerate(piece_lengths(len(tokens), limit)):
                    part = tokens[start : start + length]
                    owners.append(row)
                    rows.append((piece, start, length, zlib.crc32(part.tobytes())))
                    if with_ids:
                        ids.append(part.astype(np.int32))
                    start += length
            owner = pa.array(owners, pa.int64())
            piece, start, length, crc = zip(*rows) if rows else ((), (), (), ())
            arrays = [
                batch.column(0).take(owner), batch.column(1).take(owner),
                pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            names = ["doc_id", "text_key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    schema = "doc_id long, text_key long, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, limit: int) -> np.ndarray:
    """The bin of each piece: largest first, into the fullest bin with room for it."""
    bins_by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set if a bin has room r
    place = np.empty(len(lengths), np.int64)
    bins = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = bins_by_room[room].pop()
            if not bins_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = limit, bins
            bins += 1
        place[item] = chosen
        if room > length:
            bins_by_room[room - length].append(chosen)
            rooms |= 1 << (room - length)
    return place


class _Offers:
    """For every total length, the roomiest bin that can give one or two pieces of that length.

    A bin's offers are entered anew when it changes; old entries are dropped when they come up.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.heaps: list[list[int]] = [[] for _ in range(limit + 1)]
        self.reach = np.full(limit + 1, -1, np.int64)  # total length + room of its roomiest bin
        self.stamps: dict[int, int] = {}
        self.totals: dict[int, list[int]] = {}
        self.stamp = 0

    def enter(self, bin_: int, pieces: dict[int, list[int]], room: int) -> None:
        """``pieces`` by length; with no room the bin offers nothing."""
        self.stamp += 1
        self.stamps[bin_] = self.stamp
        old = self.totals.pop(bin_, [])
        totals = _totals(pieces) if room else []
        if totals:
            self.totals[bin_] = totals
            key = (self.limit - room) << 64 | bin_ << 32 | self.stamp
            for total in totals:
                heapq.heappush(self.heaps[total], key)
        for total in {*old, *totals}:
            self._settle(total)

    def leave(self, bin_: int) -> None:
        self.enter(bin_, {}, 0)

    def _settle(self, total: int) -> None:
        heap = self.heaps[total]
        while heap and self.stamps[heap[0] >> 32 & 0xFFFFFFFF] != heap[0] & 0xFFFFFFFF:
            heapq.heappop(heap)
        self.reach[total] = total + self.limit - (heap[0] >> 64) if heap else -1

    def least(self, wanted: np.ndarray) -> np.ndarray:
        """For each length the least total a bin would give that then has room for it."""
        return np.searchsorted(np.maximum.accumulate(self.reach), wanted)

    def bin_of(self, total: int) -> int:
        return self.heaps[total][0] >> 32 & 0xFFFFFFFF

    def fill_of(self, total: int) -> int:
        return self.heaps[total][0] >> 64


def _totals(pieces: dict[int, list[int]]) -> list[int]:
    """Nothing, and the different lengths and sums of two of them."""
    sizes = sorted(pieces)
    found = {0, *sizes}
    for i, a in enumerate(sizes):
        found.update(a + b for b in sizes[i + 1 :])
        if len(pieces[a]) > 1:
            found.add(2 * a)
    return list(found)


def _pick(pieces: dict[int, list[int]], total: int) -> list[int]:
    """Lengths of at most two pieces that sum up to ``total``."""
    if not total:
        return []
    if total in pieces:
        return [total]
    for a in pieces:
        b = total - a
        if b in pieces and (a != b or len(pieces[a]) > 1):
            return [a, b]
    raise KeyError(total)


def _take(pieces: dict[int, list[int]], length: int) -> int:
    item = pieces[length].pop()
    if not pieces[length]:
        del pieces[length]
    return item


def local_search(lengths: np.ndarray, place: np.ndarray, limit: int) -> np.ndarray:
    """Empty bins by exchanges; returns the improved bins, numbered from 0 without gaps."""
    place = place.copy()
    fill = np.bincount(place, weights=lengths).astype(np.int64)
    needed = -(-int(lengths.sum()) // limit)
    used = int((fill > 0).sum())
    emptied = True
    while emptied and used > needed:
        emptied = False
        turn = np.flatnonzero((fill > 0) & (fill < limit))
        turn = turn[np.argsort(fill[turn], kind="stable")]
        contents: dict[int, dict[int, list[int]]] = {b: {} for b in turn.tolist()}
        for item in np.flatnonzero(np.isin(place, turn)).tolist():
            contents[int(place[item])].setdefault(int(lengths[item]), []).append(item)
        # Bins not tried yet are at least as full as the one that is being emptied.
        fuller, tried = _Offers(limit), _Offers(limit)
        for b in turn.tolist():
            fuller.enter(b, contents[b], limit - int(fill[b]))
        by_fill = [(int(fill[b]), b) for b in turn.tolist()]
        waiting = set(turn.tolist())
        while by_fill and used > needed:
            held, target = heapq.heappop(by_fill)
            if held != fill[target] or held == limit or target not in waiting:
                continue
            waiting.remove(target)
            fuller.leave(target)
            own = contents[target]
            while own:
                wanted = np.array(sorted(_totals(own))[1:], np.int64)
                step = _best_step(wanted, int(fill[target]), fuller, tried)
                if step is None:
                    break
                total_out, total_back, offers = step
                there = offers.bin_of(total_back)
                other = contents[there]
                out, back = _pick(own, total_out), _pick(other, total_back)
                moved = [_take(own, x) for x in out], [_take(other, x) for x in back]
                for items, pieces, to in ((moved[0], other, there), (moved[1], own, target)):
                    for item in items:
                        place[item] = to
                        pieces.setdefault(int(lengths[item]), []).append(item)
                fill[there] += total_out - total_back
                fill[target] -= total_out - total_back
                offers.enter(there, other, limit - int(fill[there]))
                if there in waiting:
                    heapq.heappush(by_fill, (int(fill[there]), there))
            if own:
                tried.enter(target, own, limit - int(fill[target]))
            else:
                used -= 1
                emptied = True
    return np.unique(place, return_inverse=True)[1]


def _best_step(
    wanted: np.ndarray, fill: int, fuller: _Offers, tried: _Offers
) -> tuple[int, int, _Offers] | None:
    """(length out, length back, whose offer) of the exchange that takes most out of the target.

    A bin tried before may hold less than the target; it counts where the squares still rise.
    """
    found, most = None, 0
    for offers in (fuller, tried):
        given = offers.least(wanted)
        gains = wanted - given
        for at in np.argsort(-gains, kind="stable").tolist():
            gain = int(gains[at])
            if gain <= most:
                break
            total = int(given[at])
            if offers is fuller or offers.fill_of(total) + gain > fill:
                found, most = (int(wanted[at]), total, offers), gain
                break
    return found


def pack_lengths(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece."""
    place = best_fit(lengths, limit)
    place = local_search(lengths, place, limit)
    order = np.argsort(place, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.concatenate([[True], place[order][1:] != place[order][:-1]])
    base = np.maximum.accumulate(np.where(first, before, 0))
    offset = np.empty(len(lengths), np.int64)
    offset[order] = before - base
    return place, offset


def pack_documents(
    docs: DataFrame,
    limit: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None,
    group_pieces: int = GROUP_PIECES,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every document's pieces and their places in sequences of at most ``limit`` tokens.

    Returns (doc_id, text_key, piece, start, length, ids_crc32[, ids], sequence_id,
    offset). Only documents longer than a sequence are cut. Null and empty texts are one
    piece of one token; repeated rows and rows without an id are packed like others.
    Other columns play no part; an empty table gives an empty result.
    """
    pieces = stored(
        tokenized_pieces(docs, limit, vocabulary, id_column, text_column, with_ids), "pieces"
    )
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn(
        "group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    )

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        # One order however the rows arrive, so that a repeated task packs alike.
        frame = frame.sort_values(["length", "doc_id", "text_key", "piece"], ignore_index=True)
        place, offset = pack_lengths(frame["length"].to_numpy(), limit)
        frame["sequence_id"] = (frame["group"].to_numpy() << 32) + place
        frame["offset"] = offset
        return frame.drop(columns="group")

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("group").applyInPandas(pack, f"{schema}, sequence_id long, offset long")
