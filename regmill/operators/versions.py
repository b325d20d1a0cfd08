"""Running versions: the how-manieth write of its id a write is, kept from load to load.

How often each id was written so far is an index of its own, `<root>/_counts`: a load adds the totals of its own ids, and
reads those of no others. A batch is counted within itself and starts from these totals. Rows of version 2 and more are
the audit, `<root>/_audit`: their id, address, version and the whole record.

A batch that is replayed finds the totals it wrote itself the first time and starts from what they name as `before`, so its
versions do not change. Null ids are one id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmill.operators import store
from regmill.operators.ordered import running_count
from regmill.session import scratch, written


def counts_root(root: str) -> str:
    return f"{root}/_counts"


def audit_root(root: str) -> str:
    return f"{root}/_audit"


def versioned(batch: DataFrame, totals: DataFrame, key: list[str], order: list[str], into: str = "version") -> DataFrame:
    """Rows of a batch with their version, given how often each id (key, total) was written before."""
    inside = running_count(batch, F.lit(True), key, order, into, inclusive=True)
    same = reduce(lambda a, b: a & b, [F.col(f"b.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key])
    before = F.coalesce(F.col("t.total"), F.lit(0))
    joined = inside.alias("b").join(totals.alias("t"), same, "left")
    return joined.select(*[F.col(f"b.{c}") for c in batch.columns], (F.col(f"b.{into}") + before).alias(into))


def totals_before(spark: SparkSession, root: str, key: list[str], batch_id: int, load: int, source: str) -> DataFrame | None:
    """key and total of every id written before this batch; None for a new index."""
    counts = counts_root(root)
    if not store.has_writes(spark, counts):
        return None
    here = (F.col("load") == load) & (F.col("batch") == batch_id) & (F.col("source") == source)
    held = store.read_index(spark, counts, key, ["total"])
    return held.select(*key, F.when(here, F.col("before")).otherwise(F.col("total")).alias("total"))


def append_versions(
    batch: DataFrame,
    root: str,
    batch_id: int,
    key: list[str],
    order: list[str],
    url: str,
    load: int = 0,
    source: str = "main",
    into: str = "version",
) -> None:
    """Write the batch with its versions, then its audit rows, then the totals of its ids.

    Versions are written first and read back for the other two, so all three agree. The batch itself is computed once,
    into a table that is dropped at the end: counting reads it more than once.
    """
    spark = batch.sparkSession
    with scratch(spark) as kept:
        batch = written(batch, "batch")
    totals = totals_before(spark, root, key, batch_id, load, source)
    if totals is None:
        totals = batch.select(*key, F.lit(0).cast("bigint").alias("total")).where("false")
    rows = versioned(batch, totals, key, order, into)
    store.append_batch(rows, root, batch_id, load, source)
    rows = spark.read.schema(rows.schema).parquet(store.batch_folder(root, batch_id, load, source))
    record = F.to_json(F.struct(*batch.columns)).alias("record")
    audit = rows.where(F.col(into) > 1).select(*key, F.col(url).alias("url"), into, record)
    store.append_batch(audit, audit_root(root), batch_id, load, source)
    counted = rows.groupBy(*key).agg((F.min(into) - 1).alias("before"), F.max(into).alias("total"))
    store.append_batch(counted, counts_root(root), batch_id, load, source)
    kept.drop()
