"""Pages kept by their address: tables in buckets sorted by URL, for joins that are asked again and again.

Following links, merging details and finding links without a page all compare a URL with the pages'. In a store of N
buckets a page's bucket follows from its URL, so Spark reads the bucket where it would else move the page, and only
links (which are small) are dealt out. Links may be stored alike; then nothing moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmill.operators.extract import extract_links


def write_pages(pages: DataFrame, name: str, buckets: int, key: str = "url", path: str | None = None) -> str:
    """Store rows as a bucketed table, in the warehouse or below a path. Rows are dealt out by bucket first: a file a bucket, not one a
    task and bucket. A key that a third of all rows share makes one large bucket, so keys should be addresses.
    """
    dealt = pages.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(name, path=path)
    return name


def _refs(links: DataFrame, order: list[str], target: str) -> DataFrame:
    return links.groupBy(target).agg(F.min(F.struct(*order)).alias("first_ref"), F.count("*").alias("n_refs"))


def follow(spark: SparkSession, links: DataFrame, store: str, order: list[str], target: str = "target") -> DataFrame:
    """`links.follow` over a store: pages are turned to links in their bucket, the reduced listing links come to them.

    The merge hint keeps the join on the buckets' order; without it Spark might broadcast the links, which is as good while
    they are few.
    """
    pages = spark.table(store)
    found = extract_links(pages.select(F.col("url").alias(target), "html"))
    return found.join(_refs(links, order, target).hint("merge"), target).select(
        target, "first_ref", "n_refs", *[c for c in found.columns if c != target]
    )


def unmatched(spark: SparkSession, links: DataFrame, store: str, target: str = "target") -> DataFrame:
    """`links.unmatched` over a store: followed targets that have no page; of the pages only addresses are read."""
    wanted = links.groupBy(target).agg(F.count("*").alias("n_refs"))
    there = spark.table(store).select(F.col("url").alias(target))
    return wanted.join(there.hint("merge"), target, "left_anti")


def merge_details(spark: SparkSession, store: str, details: str, key: str = "url") -> DataFrame:
    """Pages with their details, both stored with as many buckets: neither side moves; shared columns are the details'."""
    pages, extra = spark.table(store), spark.table(details)
    shared = [c for c in pages.columns if c in extra.columns and c != key]
    return pages.drop(*shared).join(extra.hint("merge"), key)
