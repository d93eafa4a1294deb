"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearwatch.llm.common import discard, stored


def _lowest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours on to the smallest node it knows."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours on to the smallest of them."""
    least = _lowest(pairs)
    handed = pairs.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    Rounds of two stars until nothing changes; edges never leave the executors. A node with very
    many neighbours is a skewed join key, which adaptive execution splits; its minimum is
    aggregated before the shuffle. Null ends and loops are ignored; an empty table gives none.
    """
    spark = edges.sparkSession
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs, path = stored(start.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    mark = _mark(pairs)
    while mark[0]:
        turned, next_path = stored(_small_star(_large_star(pairs)), "stars")
        discard(spark, path)
        pairs, path, before, mark = turned, next_path, mark, _mark(turned)
        if mark == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
