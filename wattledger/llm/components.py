"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import staged


def stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b.

    Every step groups by node for the least neighbour, which is combined before the shuffle, and
    joins that back; adaptive execution splits the rows of a hub.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    least = least.select("a", F.least("_m", "a").alias("_m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    large = large.distinct()
    least = large.groupBy("a").agg(F.min("b").alias("_m"))
    hung = large.join(least, "a")
    rest = hung.where("b > _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return rest.unionByName(least.select("a", F.col("_m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label: for every node of an edge (a, b), the least node it is linked with.

    Edges may repeat and point either way; loops are left out, nulls too. Each round is a stage
    table, and rounds go on until one changes nothing.
    """
    state = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, last = staged(state.distinct(), "edges"), None
    while True:
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        mark = tuple(state.agg(F.count(F.lit(1)), digest).first())
        if mark == last:
            break
        last = mark
        state = staged(stars(state), "stars")
    centres = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        centres.select("node", F.col("node").alias("label"))
    )
