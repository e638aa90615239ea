"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from centerline.llm.common import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node to the smallest of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its neighbours below it to the smallest of these. Every edge has ``u > v``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    below = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return below.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``u, v`` of one ordered type): the smallest node reachable.

    Large and small stars alternate until nothing changes; every step keeps all components and only brings links
    closer to their smallest node. Each step is one aggregation, one join with one row per node, and a distinct, so a
    node with very many links is split like any crowded join key. Every round is written to the shared folder. Loops
    and nulls are left out; an empty table gives no rows.
    """
    now = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        now = written(_small_star(_large_star(now)), "links")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if state == before or state[0] == 0:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
