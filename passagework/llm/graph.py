"""Connected components by alternating star operations, without collecting a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.session import written


def _toward_least(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation: hang neighbours (all larger ones, or all smaller ones and the node) on the least."""
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    # from each node: to all neighbours, or to the smaller ones only
    ways = edges.union(flipped) if large else edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    least = written(ways.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m")), "least")
    hung = ways.join(least.withColumnRenamed("a", "n"), F.col("a") == F.col("n"))
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node it is connected with.

    Large-star and small-star steps alternate until nothing changes, which takes about
    as many rounds as the logarithm of the longest chain. Each step is stored, so that
    lost executors cost one step. Nulls and loops are left out. Runs jobs.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    seen = None
    while True:
        now = written(_toward_least(_toward_least(now, True), False), "edges")
        mark = now.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
