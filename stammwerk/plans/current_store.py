"""Stored current rows that a delta refreshes bucket by bucket.

The rows of an entity lie in a table partitioned by ``_bucket`` and ``_version`` and bucketed
by the columns it is joined by; ``_bucket`` is Spark's own bucket number, so a partition is
one bucket and joins still need no shuffle. A view shows, of each bucket, the one version that
is current. A refresh reads only the buckets the delta's keys fall into, writes them as a new
version beside the old one, and then replaces the view: one catalog operation that swaps all
of them. A run that dies before that has changed nothing readers see, and its files are never
looked at again.

One refresh of a table at a time; readers may go on meanwhile, on the version they started with.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.operators.flatten import TieBreaks, tie_break_of
from stammwerk.operators.versions import current_rows, gather_columns
from stammwerk.plans.entities import ENTITIES, FULL_CHAIN, Entity
from stammwerk.plans.feeds import DELTA, INITIAL
from stammwerk.sinks.writers import write_table

BUCKET = "_bucket"
VERSION = "_version"
_OURS = "stammwerk."  # what the names of a view's own properties begin with
_VERSIONS = _OURS + "versions"
_CHUNK = 200  # partitions dropped by one statement


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: which buckets it rewrote, and of how many."""

    name: str
    version: int
    touched: tuple[int, ...]
    buckets: int


def store_name(view: str) -> str:
    """The table behind a view of current rows."""
    return f"{view}_store"


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """The bucket Spark puts a row in; the columns must have the stored types."""
    return F.pmod(F.hash(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets))


def _current(versions: Sequence[int]) -> str:
    return f"{VERSION} = array({', '.join(map(str, versions))})[{BUCKET}]"


def published_properties(spark: SparkSession, view: str) -> dict[str, str]:
    """What was published with the view, besides the buckets' versions."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(view)}").collect()
    return {r.key: r.value for r in rows if r.key.startswith(_OURS) and r.key != _VERSIONS}


def published_versions(spark: SparkSession, view: str) -> list[int]:
    """The current version of each bucket."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(view)} ('{_VERSIONS}')").collect()
    return [int(v) for v in rows[0].value.split(",")]


def _publish(
    spark: SparkSession, view: str, versions: Sequence[int], columns: Sequence[str], properties: Mapping[str, str]
) -> None:
    shown = ", ".join(f"`{c}`" for c in columns)
    stated = {**properties, _VERSIONS: ",".join(map(str, versions))}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in stated.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(view)} TBLPROPERTIES ({listed})"
        f" AS SELECT {shown} FROM {_quoted(store_name(view))} WHERE {_current(versions)}"
    )


def _partitions(spark: SparkSession, view: str) -> list[tuple[int, int]]:
    """(bucket, version) of all stored partitions, current or not."""
    rows = spark.sql(f"SHOW PARTITIONS {_quoted(store_name(view))}").collect()
    pairs = [dict(p.split("=") for p in row.partition.split("/")) for row in rows]
    return [(int(p[BUCKET]), int(p[VERSION])) for p in pairs]


def _stored_as(rows: DataFrame, version: int, bucket_by: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, bucket_of(bucket_by, buckets)).withColumn(VERSION, F.lit(version))


def build_current(
    rows: DataFrame,
    view: str,
    bucket_by: Sequence[str],
    buckets: int | None = None,
    sort_columns: Sequence[str] = (),
    path: str | None = None,
    properties: Mapping[str, str] | None = None,
    gathered: bool = False,
) -> str:
    """Store ``rows``, one per key, as the first version of all buckets; returns the view's name.

    ``properties``, whose names begin with ``stammwerk.``, are published together with the rows.
    ``gathered`` says that rows come gathered by ``bucket_by``.
    """
    spark = rows.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_table(
        _stored_as(rows, 0, bucket_by, buckets), store_name(view), INITIAL, [BUCKET, VERSION], bucket_by, buckets,
        path=path, sort_columns=list(sort_columns or bucket_by), gathered=gathered,
    )
    _publish(spark, view, [0] * buckets, rows.columns, properties or {})
    return view


def current_buckets(spark: SparkSession, view: str, touched: Sequence[int]) -> DataFrame:
    """The current rows of some buckets; the scan lists only their files."""
    versions = published_versions(spark, view)
    rows = spark.table(store_name(view)).where(F.col(BUCKET).isin(list(touched)))
    return rows.where(F.expr(_current(versions))).drop(BUCKET, VERSION)


def refresh_current(
    delta: DataFrame,
    view: str,
    keys: Sequence[str],
    bucket_by: Sequence[str],
    pick: Callable[..., DataFrame] = current_rows,
    properties: Mapping[str, str] | None = None,
    gathered: bool = False,
    **options,
) -> Refresh:
    """Bring the stored current rows up to date with new versions.

    ``pick(rows, keys, **options)`` keeps one version per key and must not depend on rows
    that lose (:func:`stammwerk.operators.versions.current_rows` by default), so late versions,
    older than the stored one, and versions delivered again change nothing. Columns are
    found by name and cast to the stored types; the result equals a rebuild from all
    versions. ``bucket_by`` holds some or all of ``keys``. ``properties`` change in the same
    operation as the rows. ``gathered`` says that ``pick`` leaves rows gathered by ``bucket_by``.
    """
    spark = delta.sparkSession
    versions = published_versions(spark, view)
    published = published_properties(spark, view) | dict(properties or {})
    columns = spark.table(view).schema
    aligned = delta.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns])
    # The buckets follow from the keys alone; versions are picked once, together with the stored rows.
    bucket = bucket_of(bucket_by, len(versions))
    touched = sorted(r[0] for r in aligned.select(bucket.alias(BUCKET)).distinct().collect())
    if not touched:
        if properties:
            _publish(spark, view, versions, columns.names, published)
        return Refresh(view, max(versions), (), len(versions))
    before = current_buckets(spark, view, touched)
    rows = pick(before.unionByName(aligned), keys, **options)
    version = max(v for _, v in _partitions(spark, view) or [(0, 0)]) + 1
    write_table(_stored_as(rows, version, bucket_by, len(versions)), store_name(view), DELTA, gathered=gathered)
    held = set(touched)
    _publish(spark, view, [version if b in held else v for b, v in enumerate(versions)], columns.names, published)
    return Refresh(view, version, tuple(touched), len(versions))


def drop_old_versions(spark: SparkSession, view: str) -> int:
    """Delete the buckets' versions that are no longer shown; returns how many.

    For when no reader of an older version is left.
    """
    versions = published_versions(spark, view)
    old = [(b, v) for b, v in _partitions(spark, view) if versions[b] != v]
    for at in range(0, len(old), _CHUNK):
        parts = ", ".join(f"PARTITION ({BUCKET} = {b}, {VERSION} = {v})" for b, v in old[at : at + _CHUNK])
        spark.sql(f"ALTER TABLE {_quoted(store_name(view))} DROP {parts}")
    return len(old)


# --- the flattened entities ----------------------------------------------------


def _bucket_by(entity: Entity) -> Sequence[str]:
    return entity.join_keys or entity.keys


def build_current_tables(
    spark: SparkSession,
    schema: str,
    inputs: Mapping[str, DataFrame],
    tie_breaks: TieBreaks | None = None,
    buckets: int | None = None,
) -> list[str]:
    """Store the current rows of each entity so that they can be refreshed.

    The views have the names :func:`stammwerk.operators.flatten.read_entities` looks for.
    """
    views = []
    for entity in FULL_CHAIN:
        if entity.name in inputs:
            versions = inputs[entity.name]
            rows = current_rows(
                versions, entity.keys, tie_break_of(entity, versions, tie_breaks),
                gather_by=gather_columns(_bucket_by(entity), entity.keys),
            )
            sort = list(dict.fromkeys([*_bucket_by(entity), *entity.keys]))
            views.append(build_current(rows, f"{schema}.{entity.view}", _bucket_by(entity), buckets, sort, gathered=True))
    return views


def refresh_current_tables(
    schema: str, deltas: Mapping[str, DataFrame], tie_breaks: TieBreaks | None = None
) -> list[Refresh]:
    """Refresh the entities that have new versions; the others are not read."""
    done = []
    for name, delta in deltas.items():
        entity = ENTITIES[name]
        done.append(
            refresh_current(
                delta, f"{schema}.{entity.view}", entity.keys, _bucket_by(entity),
                gathered=True, tie_break=tie_break_of(entity, delta, tie_breaks),
                gather_by=gather_columns(_bucket_by(entity), entity.keys),
            )
        )
    return done
