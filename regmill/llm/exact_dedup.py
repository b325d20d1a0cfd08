"""Exact duplicates: heavy-hitter digests are settled by a broadcast, the others by a shuffle.

Every text has its SHA-256 as digest (null counts as the empty text). Misra-Gries summaries of
`counters` entries per task, added up per digest, hold every digest with more than rows / (counters + 1)
rows. Their true winners and sizes come from a combinable aggregate and are broadcast: at most
`counters` rows, whatever the input. So a digest with a third of all rows is never gathered; the
remaining digests are shuffled, and none of them has more than rows / counters rows.

Rows with equal texts are ordered by id, null ids first, and the last one stays; of rows equal in id and
text, one stays. An empty table gives an empty result; further columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regmill.llm.registry import documents, query
from regmill.session import written

COUNTERS = 1024


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def misra_gries(counts: dict[bytes, int], seen: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """The summary `counts` after the rows counted in `seen`; at most `counters` entries."""
    for key, n in seen.items():
        counts[key] = counts.get(key, 0) + n
    if len(counts) > counters:
        cut = sorted(counts.values(), reverse=True)[counters]
        counts = {key: n - cut for key, n in counts.items() if n > cut}
    return counts


def heavy_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, with every one of more than rows / (counters + 1) rows among them."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            seen = pc.value_counts(batch.column(0))
            pairs = zip(seen.field(0).to_pylist(), seen.field(1).to_pylist(), strict=True)
            counts = misra_gries(counts, dict(pairs), counters)
        keys, values = pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())
        yield pa.RecordBatch.from_arrays([keys, values], ["digest", "n"])

    parts = rows.select("digest").mapInArrow(summarise, "digest binary, n bigint")
    total = parts.groupBy("digest").agg(F.sum("n").alias("n"))
    # a digest that one task saw once tells nothing; what is left is ordered, ties by digest
    return total.where("n > 1").orderBy(F.desc("n"), "digest").limit(counters).select("digest")


def _winners(rows: DataFrame, counters: int) -> DataFrame:
    heavy = F.broadcast(heavy_digests(rows, counters))
    return (
        rows.join(heavy, "digest")
        .groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("group_size"))
    )


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (lower-case hex)."""
    rows = written(
        docs.select(F.col(id).alias("id"), digest_of(F.col(text)).alias("digest")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "digests",
    )
    winners = F.broadcast(_winners(rows, counters))
    marked = rows.join(winners, "digest", "left")
    group = Window.partitionBy("digest")
    light = (
        marked.where("group_size is null")
        .withColumn("top", F.max(F.struct("id", "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return marked.where("group_size is not null").unionByName(light).select(
        F.col("id").alias(id),
        F.col("top.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.

    Copies of frequent texts go before the shuffle; the rest is a rank of one per digest.
    """
    rows = written(
        docs.select(F.col(id).alias("id"), digest_of(F.col(text)).alias("digest"), F.lit(0).alias("row")), "digests"
    )
    winners = F.broadcast(_winners(rows, counters).select(F.col("digest").alias("_digest"), "top.id"))
    names = docs.columns
    tagged = docs.select(F.struct(*names).alias("_doc"), digest_of(F.col(text)).alias("_digest"))
    light = tagged.join(winners.withColumnRenamed("id", "_keep").withColumn("_heavy", F.lit(True)), "_digest", "left")
    light = light.where(F.col("_heavy").isNull() | F.col("_keep").eqNullSafe(F.col("_doc")[id]))
    last = Window.partitionBy("_digest").orderBy(F.col("_doc")[id].desc_nulls_last())
    return light.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").select("_doc.*")


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query("op7_exact_dedup", SQL)
def op7(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir))
