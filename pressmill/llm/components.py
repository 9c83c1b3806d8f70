"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressmill.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node of ``edges``; the component is its smallest node.

    Each round first links every node's larger neighbours to its smallest
    neighbour, then its smaller ones, and writes the edges out. Neighbours are
    never gathered: a node's minimum is a partial aggregate, and the join that
    hands it out can be split where a node has very many edges. Edges with a
    null end and loops are left out; an empty table has no components.
    """
    spark = edges.sparkSession
    high, low = F.greatest(a, b).cast("bigint"), F.least(a, b).cast("bigint")
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialize(spark, now.select(high.alias("u"), low.alias("v")).distinct(), "components")
    state = _state(now)
    while state[0]:
        now = materialize(spark, _small_star(_large_star(now)).distinct(), "components")
        after = _state(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over them; the same after a round that changes nothing."""
    code = F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(code), F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.distinct()
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))
