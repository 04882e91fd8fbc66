"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.session import durable


def _unfinished(edges: DataFrame) -> bool:
    """Whether some id hangs on two others, or has one hanging on it and hangs itself."""
    roles = edges.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("hangs")), F.struct(F.col("b").alias("id"), F.lit(1).alias("hangs")))).alias("r"))
    per_id = roles.select("r.*").groupBy("id").agg(F.sum("hangs").alias("n"), F.count("*").alias("all"))
    return not per_id.where("n > 0 and (n > 1 or all > n)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reached) of every id in ``links`` (a, b).

    Alternates large-star and small-star steps: every id is tied to the smallest id
    among its neighbours until only stars are left. Each step is a partial minimum per
    id and a join back, both of which Spark can split for an id with many links, and
    is written down, so that a lost executor repeats one step at most.
    """
    edges = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while _unfinished(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a").select(F.col("m").alias("a"), "b")
        up = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        lowest = up.groupBy("a").agg(F.min("b").alias("m"))
        small = up.join(lowest, "a").select(F.explode(F.array(F.struct("m", F.col("a").alias("v")), F.struct("m", F.col("b").alias("v")))).alias("e"))
        edges = durable(small.where("e.m <> e.v").select(F.col("e.m").alias("a"), F.col("e.v").alias("b")).distinct())
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())
