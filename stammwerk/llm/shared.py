"""What the text operators share: words, stored intermediate tables, document keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stammwerk.session import fresh_path

# Entries a worker's word cache holds before it starts anew.
CACHE_WORDS = 1_000_000


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; null is the empty text."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return text_bytes(text).split()


class WordHashes(dict):
    """64-bit hashes of words, remembered while a worker meets them again."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps start from there."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(column: str | Column) -> Column:
    """Tells rows of one document id with different texts apart."""
    return F.xxhash64(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))


def hashed_share(hashed: Column, rows: int, wanted: int) -> Column:
    """True for about ``wanted`` of ``rows`` rows, by their hash; for all if there are fewer.

    A sample is first thinned by this and only then sorted, so that what one task sorts
    does not grow with the table.
    """
    range_of = 1 << 40
    below = range_of if rows <= wanted else max(1, range_of * wanted // rows)
    return F.pmod(hashed, F.lit(range_of)) < F.lit(below)


def in_batches(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``rows``."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
