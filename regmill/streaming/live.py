"""Live listings: of every visit of a source's listing, the rows above the first row of the visit before.

A listing shows the newest first and is read again and again. What is new in a visit (run) are the rows in front of the
title that headed the run before. This mark is the only state: a row per source, written as a version per micro-batch
below `<root>/_marks`. A micro-batch starts from the newest version of an earlier batch, so a replayed one cuts where it cut the
first time. Several runs may come in one micro-batch and one run in several: the state holds the mark of the run it
is in, where in the run that mark was found, and what heads it.

Runs of a source come in order of their number; a piece of an older run is cut at the mark held before the run in the state.
Rows without a title are new if they stand above the mark and never become a mark. A source without a mark takes all its
first run. Null sources are one source.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from regmill.operators import folders
from regmill.operators.store import append_batch
from regmill.streaming.incremental import load_number, run_batches

KEPT = 10  # versions of the marks


def state_schema(listing: StructType, by: list[str], run: str, title: str, pos: str) -> StructType:
    """source, run, its mark (`before`), what heads it, and where the mark was found in it."""
    kinds = {"run": run, "before": title, "head": title, "head_pos": pos, "reached": pos}
    fields = [listing[c] for c in by] + [StructField(n, listing[c].dataType) for n, c in kinds.items()]
    return StructType([StructField(f.name, f.dataType) for f in fields])


def _same(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns])


def marked_runs(listing: DataFrame, state: DataFrame, by: list[str], run: str, title: str, pos: str) -> DataFrame:
    """source, run, before, head, head_pos and reached of every run of the listing and of the state: a row a run."""
    titled = listing.where(F.col(title).isNotNull())
    heads = titled.groupBy(*by, F.col(run).alias("run")).agg(
        F.min_by(title, pos).alias("head"), F.min(pos).alias("head_pos")
    )
    found = heads.withColumn("held", F.lit(False)).unionByName(state.withColumn("held", F.lit(True)), allowMissingColumns=True)
    runs = found.groupBy(*by, "run").agg(
        F.max("held").alias("held"),
        F.max(F.when(F.col("held"), F.struct("before"))).alias("before"),
        F.coalesce(F.min_by("head", "head_pos"), F.max("head")).alias("head"),
        F.min("head_pos").alias("head_pos"),
        F.min("reached").alias("reached"),
    )
    # a row a run of a source, so these windows stay small
    inside = Window.partitionBy(*by)
    in_order = inside.orderBy(F.col("run").asc_nulls_first())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last("head", ignorenulls=True).over(earlier)
    late = ~F.col("held") & (F.col("run") < F.max(F.when(F.col("held"), F.col("run"))).over(inside))
    kept = F.max(F.when(F.col("held"), F.col("before"))).over(inside)
    before = F.when(F.col("held"), F.col("before.before")).when(late, kept["before"]).otherwise(last)
    runs = runs.withColumn("before", before)
    hits = listing.select(*by, F.col(run).alias("run"), F.col(title).alias("before"), pos).alias("a")
    hits = hits.join(runs.where("before is not null").select(*by, "run", "before").alias("b"), _same([*by, "run", "before"]))
    hits = hits.groupBy(*[F.col(f"a.{c}") for c in (*by, "run")]).agg(F.min(f"a.{pos}").alias("here"))
    joined = runs.alias("a").join(hits.alias("b"), _same([*by, "run"]), "left")
    kept_columns = [F.col(f"a.{c}") for c in (*by, "run", "before", "head", "head_pos")]
    return joined.select(*kept_columns, F.least("a.reached", "b.here").alias("reached"))


def above_marks(listing: DataFrame, runs: DataFrame, by: list[str], run: str, pos: str) -> DataFrame:
    """Rows of the listing in front of their run's mark; all where it was not found."""
    cuts = runs.where("reached is not null").select(*by, F.col("run").alias(run), "reached")
    joined = listing.alias("a").join(cuts.alias("b"), _same([*by, run]), "left")
    front = F.col("b.reached").isNull() | (F.col(f"a.{pos}") < F.col("b.reached"))
    return joined.where(front).select("a.*")


def latest_runs(runs: DataFrame, by: list[str]) -> DataFrame:
    """The state after these runs: the last run of each source."""
    rest = F.struct("before", "head", "head_pos", "reached")
    place = F.struct(F.col("run").isNotNull().alias("some"), "run")
    last = runs.groupBy(*by).agg(F.max_by(F.struct("run", rest.alias("rest")), place).alias("last"))
    return last.select(*by, "last.run", "last.rest.*")


def marks_before(spark: SparkSession, root: str, batch_id: int, schema: StructType) -> DataFrame:
    """The newest state of an earlier batch; the initial one before the first."""
    held = {folders.value_in(p, "batch"): p for p in folders.committed(spark, f"{root}/batch=*")}
    earlier = [n for n in held if n < batch_id]
    return spark.read.schema(schema).parquet(held[max(earlier)] if earlier else f"{root}/initial")


def run_live(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    by: list[str],
    run: str,
    title: str,
    pos: str,
    build: Callable[[DataFrame], DataFrame],
    source: str = "live",
    marks: DataFrame | None = None,
) -> StreamingQuery:
    """Append what is new in the listings of the stream to an index, and stop.

    `marks` (source columns and `mark`) is where earlier loads got to, as `ordered.high_water` reads it off the index; it is
    written down on the first start, before this load adds anything to that index.
    """
    spark = stream.sparkSession
    number = load_number(spark, root, checkpoint)
    place = f"{root}/_marks/load={number}"
    schema = state_schema(stream.schema, by, run, title, pos)
    if not folders.committed(spark, f"{place}/initial"):
        first = spark.createDataFrame([], schema)
        if marks is not None:
            known = marks.select(*by, F.col("mark").alias("head"))
            first = known.select(*[F.col(f.name) if f.name in known.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        first.write.mode("overwrite").parquet(f"{place}/initial")

    def load(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession
        runs = marked_runs(batch, marks_before(here, place, batch_id, schema), by, run, title, pos)
        append_batch(build(above_marks(batch, runs, by, run, pos)), root, batch_id, number, source)
        latest_runs(runs, by).select(*schema.names).write.mode("overwrite").parquet(f"{place}/batch={batch_id}")
        for path in folders.found(here, f"{place}/batch=*"):
            if folders.value_in(path, "batch") < batch_id - KEPT:
                folders.delete(here, path)

    return run_batches(stream, checkpoint, load)
