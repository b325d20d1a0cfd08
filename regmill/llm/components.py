"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.session import written


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """node and root (the least node it reaches) of every node of the links (a, b), both bigint, not null.

    Each round is two joins with a combinable minimum, so a hub is never gathered; edges end up pointing from
    every node to the least one, in a number of rounds that grows with the logarithm of the graph.
    Rounds are written to the shared folder, in at most `files` files each. No links, no rows.
    """
    edges = written(_down(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges", files)
    before = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before or not now["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _down(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(_down(small.unionByName(least.select("u", F.col("m").alias("v")))), "edges", files)


def _down(edges: DataFrame) -> DataFrame:
    pairs = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return pairs.distinct()
