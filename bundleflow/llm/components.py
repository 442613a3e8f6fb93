"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    around = down.join(least, "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return around.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) of every node of ``edges`` (columns a, b, of an ordered type); the label is
    the least node of its component.  Each step is written, so lineage stays short."""
    now = scratch.write(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (found[0], found[1]) == state or not found[0]:
            break
        state, step = (found[0], found[1]), step + 1
        after = scratch.write(_small_star(_large_star(now)), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
        now = after
    return (now.select(F.col("b").alias("node"), F.col("a").alias("label"))
            .union(now.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct())
