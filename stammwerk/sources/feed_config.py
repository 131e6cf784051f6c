"""Feed configurations: a JSON document to a DataFrame with one row per feed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stammwerk.functions.load_metadata import BOOK_DATE
from stammwerk.plans.feeds import INITIAL, FeedSpec, check_load_type

# Fixed value: the shape of a configuration document.
CONFIG_SCHEMA = """
    process_Info struct<
        process_descr: string, source_system: string, tenant_process: string, version: string>,
    feedEntities map<string, struct<
        type: string,
        initial_query: string, delta_query: string,
        spec: struct<
            hub: string, satellite: string, key: string,
            hub_columns: array<string>, satellite_columns: array<string>,
            equals: map<string, string>, unit_code: string, unit_names: map<string, string>,
            version_columns: array<string>, tie_break: string, hub_is_unique: boolean>,
        target_dataset: string, target_tableName: string,
        partition_enabled: string, partition_columns: array<string>,
        cluster_enabled: string, cluster_columns: array<string>,
        static_metadata_fields: array<string>>>,
    loadStrategy struct<
        load: string, load_type: string,
        partition: struct<enabled: string, partition_by: string>>
"""


@dataclass(frozen=True)
class FeedPlan:
    """What to run for one feed: its declared specification, a built-in one, or a query."""

    feed: str
    job: str
    process: str
    tenant_process: str
    source_system: str
    load_type: str
    changed_since: str | None
    query: str | None
    target: str
    partition_columns: tuple[str, ...]
    cluster_columns: tuple[str, ...]
    metadata_fields: tuple[str, ...]
    spec: FeedSpec | None = None


def declared_feed(name: str, stated: Mapping[str, Any]) -> FeedSpec:
    """A feed as a configuration declares it: the fields of ``FeedSpec`` that are not default.

    Values of ``equals`` are texts there and compared as the column's type.
    """
    needed = ("hub", "satellite", "key", "hub_columns", "satellite_columns")
    missing = [field for field in needed if not stated.get(field)]
    if missing:
        raise ValueError(f"the specification of {name} lacks {missing}")
    given = {k: tuple(v) if isinstance(v, list) else v for k, v in stated.items() if v is not None}
    return FeedSpec(name, **given)


def read_feed_config(spark: SparkSession, path: str) -> DataFrame:
    """The configuration as one row. A broken or incomplete document raises."""
    config = spark.read.json(path, schema=CONFIG_SCHEMA, multiLine=True, mode="FAILFAST")
    row = config.select(
        (F.col("process_Info").isNotNull() & F.col("feedEntities").isNotNull()).alias("complete")
    ).collect()
    if [r.complete for r in row] != [True]:
        raise ValueError(f"{path} is not one document with process_Info and feedEntities")
    return config


def _stated(value: Column) -> Column:
    """Null where the text is missing or still a template placeholder."""
    return F.when(~value.contains("{{"), value)


def _enabled(flag: Column) -> Column:
    return F.lower(F.coalesce(flag, F.lit("No"))) == "yes"


def _strategy_partition(strategy: Column) -> Column:
    """The partition column of the load strategy: ``{{book_date}}`` is the stamped book date."""
    stated = strategy["partition_by"]
    book_date = stated.rlike(r"^\s*\{\{\s*book_date\s*\}\}\s*$")
    return F.when(book_date, F.lit(BOOK_DATE)).otherwise(_stated(stated))


def _if_enabled(flag: Column, columns: Column) -> Column:
    none = F.array().cast("array<string>")
    return F.when(_enabled(flag), F.coalesce(columns, none)).otherwise(none)


def expand_feeds(
    config: DataFrame,
    load_type: str | None = None,
    changed_since: date | str | None = None,
) -> DataFrame:
    """One row per feed in document order.

    The load strategy supplies the load type and the partition column where neither
    the caller nor the feed states one; ``{{book_date}}`` there means the stamped book
    date. A strategy whose ``load`` is not ``yes`` leaves no feeds. Layout columns count only where their flag
    is ``yes``.
    """
    if load_type is not None:
        check_load_type(load_type)
    chosen = F.coalesce(F.lit(load_type), _stated(F.col("loadStrategy.load_type")))
    strategy = F.col("loadStrategy.partition")
    default = _strategy_partition(strategy)
    default_partition = F.when(
        _enabled(strategy["enabled"]) & default.isNotNull(), F.array(default)
    ).otherwise(F.array().cast("array<string>"))
    loads = F.coalesce(F.lower(_stated(F.col("loadStrategy.load"))), F.lit("yes")) == "yes"
    feeds = config.where(loads).select(
        F.posexplode("feedEntities").alias("position", "feed", "item"),
        F.col("process_Info.process_descr").alias("process"),
        F.col("process_Info.tenant_process").alias("tenant_process"),
        F.col("process_Info.source_system").alias("source_system"),
        chosen.alias("load_type"),
        default_partition.alias("default_partition"),
    )
    return feeds.select(
        "position",
        "feed",
        F.concat_ws("_", "process", "source_system", "feed").alias("job"),
        "process",
        "tenant_process",
        "source_system",
        "load_type",
        F.lit(None if changed_since is None else str(changed_since)).cast("string").alias(
            "changed_since"
        ),
        F.when(F.col("load_type") == INITIAL, F.col("item.initial_query"))
        .otherwise(F.col("item.delta_query"))
        .alias("query"),
        F.concat_ws(".", "item.target_dataset", "item.target_tableName").alias("target"),
        F.when(
            F.col("item.partition_enabled").isNull(), F.col("default_partition")
        )
        .otherwise(_if_enabled(F.col("item.partition_enabled"), F.col("item.partition_columns")))
        .alias("partition_columns"),
        _if_enabled(F.col("item.cluster_enabled"), F.col("item.cluster_columns")).alias(
            "cluster_columns"
        ),
        F.coalesce(
            F.col("item.static_metadata_fields"), F.array().cast("array<string>")
        ).alias("metadata_fields"),
        F.col("item.spec").alias("spec"),
    ).orderBy("position")


def feed_plans(feeds: DataFrame) -> list[FeedPlan]:
    """The feeds of one configuration document, to be run one job each."""
    plans = []
    for row in feeds.orderBy("position").drop("position").collect():
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in row.asDict().items()}
        if values["spec"]:
            values["spec"] = declared_feed(row.feed, row.spec.asDict())
        check_load_type(values["load_type"])
        plans.append(FeedPlan(**values))
    return plans
