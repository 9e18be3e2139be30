"""Connected components of an edge table, by rounds of large and small stars.

Every round is a few grouped joins over the edges; the edge table is written
after each, so lineage stays short and a lost executor repeats one round at
most. A node with very many edges is pre-aggregated (minimum) before the
shuffle, and the join on it is one whose partitions Spark can split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import materialise, release_shuffles


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                          F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its least neighbour to its larger neighbours."""
    arcs = _both(edges)
    least = arcs.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("w"), F.least("u", "least").alias("least"))
    return arcs.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    linked = down.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("least").alias("b"))
    return linked.union(least.select(F.col("u").alias("a"), F.col("least").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (a, b): root is the least
    node reachable. Ends when a round changes nothing: then each edge is a
    node and its root. Every round but the last lowers some end of an edge, so it
    does end, on chains of any length."""
    spark = edges.sparkSession
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")),
                                    F.sum(F.hash("b", "a", F.lit(1)).cast("long"))).first())
    edges = materialise(edges.select("a", "b").where("a <> b"), f"{name}-edges")
    seen = None
    while True:
        edges = materialise(_small_star(_large_star(edges)), f"{name}-edges")
        now = state(edges)
        release_shuffles(spark)
        if now == seen or not now[0]:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
