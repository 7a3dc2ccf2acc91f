"""Connected components of a link table, by alternating star steps: every node
links its larger (then its smaller) neighbours to the smallest one it knows,
until nothing changes. All state stays in Spark tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b) with a > b; large: each node takes its larger neighbours to its
    minimum; else each node and its smaller neighbours go to the minimum."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = near.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (a, b), the smallest node
    reachable from it. Nodes without a link do not appear."""
    edges = stage(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    before = None
    while True:
        edges = stage(spark, _star(_star(edges, True), False), "star")
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
