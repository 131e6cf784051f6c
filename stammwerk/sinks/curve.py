"""Files clustered by several columns at once, along a space-filling curve.

Rows sorted by (a, b) have narrow files in ``a`` only. Here every cluster column is cut into
ranges of about equally many rows, the bits of a row's range numbers are interleaved into its
place on a Z-curve, and files are runs of that curve, so each of them is narrow in every column.
What each file holds of them stands in a manifest, and a reader opens only the files whose ranges
meet its own.

A load is three passes: quantiles (one aggregate of mergeable sketches over all columns), the
shuffle into runs of the curve, and the manifest (one aggregate over the written files). Its rows
are visible once its manifest is there, so a load that dies half-way leaves nothing behind that a
reader sees.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS, FILES = "rows", "files"
# Ranges per column are at most 2 ** this; finer ranges than files need bring nothing.
MOST_BITS = 10
# A place on the curve is a long.
PLACE_BITS = 62
# Bytes of a string, after what all of them begin with, that decide its range.
STRING_BYTES = 6

Bounds = dict[str, list[float]]


def bits_for(files: int, columns: int) -> int:
    """Bits per column: two more than would give each file its own cell of the curve."""
    needed = math.ceil(math.log2(max(files, 2)) / columns) + 2
    return max(1, min(needed, MOST_BITS, PLACE_BITS // columns))


def _shared_start(low: bytes, high: bytes) -> int:
    same = 0
    while same < min(len(low), len(high)) and low[same] == high[same]:
        same += 1
    return same


def sort_keys(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """For each column a double that rises (weakly) with its values.

    Strings go by the ``STRING_BYTES`` bytes after those that all of them begin with, which the
    least and greatest value tell. Only the layout of the files depends on these numbers.
    """
    types = {c: df.schema[c].dataType for c in columns}
    texts = [c for c in columns if isinstance(types[c], T.StringType)]
    starts = {}
    if texts:
        raw = {c: F.encode(F.col(f"`{c}`"), "UTF-8") for c in texts}
        row = df.agg(*[f(raw[c]).alias(f"{k}{i}") for i, c in enumerate(texts)
                       for k, f in (("a", F.min), ("z", F.max))]).first()
        starts = {c: _shared_start(bytes(row[f"a{i}"] or b""), bytes(row[f"z{i}"] or b""))
                  for i, c in enumerate(texts)}
    keys = {}
    for c, kind in types.items():
        value = F.col(f"`{c}`")
        if isinstance(kind, T.StringType):
            part = F.substring(F.encode(value, "UTF-8"), starts[c] + 1, STRING_BYTES)
            digits = F.rpad(F.hex(part), 2 * STRING_BYTES, "0")
            keys[c] = F.conv(digits, 16, 10).cast("double")
        elif isinstance(kind, T.DateType):
            keys[c] = F.unix_date(value).cast("double")
        elif isinstance(kind, T.TimestampType):
            keys[c] = F.unix_micros(value).cast("double")
        elif isinstance(kind, T.TimestampNTZType):
            keys[c] = F.unix_micros(F.to_timestamp_ltz(value)).cast("double")
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            keys[c] = value.cast("double")
        else:
            raise TypeError(f"cannot cluster by {c} of type {kind.simpleString()}")
    return keys


def range_bounds(df: DataFrame, keys: Mapping[str, Column], bits: int) -> Bounds:
    """The inner bounds of 2 ** bits ranges per column, by one pass over all rows.

    A value that fills several ranges gives equal bounds; it then is one range of its own.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    accuracy = 20 * 2**bits
    row = df.agg(*[F.percentile_approx(k, shares, accuracy).alias(f"b{i}")
                   for i, k in enumerate(keys.values())]).first()
    return {c: list(row[f"b{i}"] or [0.0] * len(shares)) for i, c in enumerate(keys)}


def range_number(key: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are not above ``key`` (null: none), by halving."""
    bits = (len(bounds) + 1).bit_length() - 1
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    table = F.lit(list(bounds))
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - F.lit(1)) <= key, at + step).otherwise(at),
    )


def curve_place(numbers: Sequence[Column], bits: int) -> Column:
    """The bits of all numbers in turn, highest first, as one long."""
    place = F.lit(0).cast("long")
    for b in range(bits):
        for j, number in enumerate(numbers):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, b * len(numbers) + len(numbers) - 1 - j))
    return place


def _no_other(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def write_curve(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, bits: int | None = None,
) -> str:
    """Add ``df`` as one load of about ``files`` files below ``path``; returns the load's id.

    ``files`` defaults to ``spark.sql.shuffle.partitions``. Rows of one place on the curve are
    told apart by the cluster columns and then by a hash of the whole row, so a frequent value
    does not end up in one task; rows equal in every column stay together. Nulls lie before all
    values. All rows are kept, repeated ones too; an empty frame is a load of no files.
    ``df`` is read two to three times: store it first where that is dear.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        raise ValueError("no cluster columns")
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = bits or bits_for(files, len(columns))
    keys = sort_keys(df, columns)
    bounds = range_bounds(df, keys, bits)
    place, salt = _no_other(df, "curve_place"), _no_other(df, "curve_salt")
    hashable = [F.col(f"`{f.name}`") for f in df.schema if not _holds_map(f.dataType)]
    numbers = [range_number(keys[c], bounds[c]) for c in columns]
    order = [F.col(place), *[F.col(f"`{c}`") for c in columns], F.col(salt)]
    load = uuid.uuid4().hex
    (
        df.withColumns({place: curve_place(numbers, bits), salt: F.xxhash64(*hashable)})
        .repartitionByRange(files, *order)
        .sortWithinPartitions(*order)
        .drop(place, salt)
        .write.parquet(f"{path}/{ROWS}/{load}")
    )
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/{ROWS}/{load}")
    spans = [f(F.col(f"`{c}`")).alias(f"{k}_{c}") for c in columns for k, f in (("least", F.min), ("most", F.max))]
    (
        rows.groupBy(F.lit(load).alias("load"), F.col("_metadata.file_name").alias("file"))
        .agg(F.count("*").alias("n_rows"), *spans)
        .coalesce(1)
        .write.parquet(f"{path}/{FILES}/{load}")
    )
    return load


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(load, file, n_rows, least_<column>, most_<column> ...) of every visible file."""
    return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/{FILES}")


def files_for(spark: SparkSession, path: str, ranges: Mapping[str, tuple[object, object]]) -> list[str]:
    """The files that may hold rows whose columns lie in all ``ranges`` (None: open end)."""
    there = manifest(spark, path)
    for column, (low, high) in ranges.items():
        if f"least_{column}" not in there.columns:
            continue
        kind = there.schema[f"least_{column}"].dataType
        there = there.where(F.col(f"`least_{column}`").isNotNull())
        if low is not None:
            there = there.where(F.col(f"`most_{column}`") >= F.lit(low).cast(kind))
        if high is not None:
            there = there.where(F.col(f"`least_{column}`") <= F.lit(high).cast(kind))
    return [f"{path}/{ROWS}/{r.load}/{r.file}" for r in there.select("load", "file").collect()]


def read_curve(
    spark: SparkSession, path: str, ranges: Mapping[str, tuple[object, object]] | None = None,
) -> DataFrame:
    """The rows of all loads, or those whose columns lie within ``ranges``, both ends included.

    Only the files the manifest names for them are opened. Nulls lie in no range. Columns that
    are not clustered prune nothing here but are filtered as well.
    """
    ranges = ranges or {}
    loads = [r.load for r in manifest(spark, path).select("load").distinct().collect()]
    if not loads:  # only empty loads so far: their files have a schema and no rows
        return spark.read.option("recursiveFileLookup", True).parquet(f"{path}/{ROWS}").limit(0)
    schema = spark.read.parquet(f"{path}/{ROWS}/{loads[0]}").schema
    chosen = files_for(spark, path, ranges)
    found = spark.read.schema(schema).parquet(*chosen) if chosen else spark.createDataFrame([], schema)
    for column, (low, high) in ranges.items():
        kind, value = schema[column].dataType, F.col(f"`{column}`")
        found = found.where(value.isNotNull())
        if low is not None:
            found = found.where(value >= F.lit(low).cast(kind))
        if high is not None:
            found = found.where(value <= F.lit(high).cast(kind))
    return found
