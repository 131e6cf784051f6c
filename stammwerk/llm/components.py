"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stammwerk.llm.shared import stored


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row.n, row.s


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Each larger neighbour of u is tied to the least node around u.
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        .select("e.u", "e.v")
        .where("u <> v")
    )


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge but the roots; the root is the least node.

    Nodes are longs. Edges may repeat, point either way, or join a node to itself
    (ignored); edges with a null end are ignored. The number of rounds grows with the
    logarithm of the longest path. Every round is written to the shared folder; only
    a count and a checksum of the edges reach the driver. A hub with many edges is a
    hot join key with one row on the other side, which AQE splits.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    current = stored(pairs.distinct(), "edges")
    before = _signature(current)
    while before[0]:
        current = stored(_small_star(_large_star(current)).distinct(), "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
