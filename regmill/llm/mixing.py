"""Mix sources to target weights along a curriculum that changes with the position in training.

Targets: source i of weight w_i and size s_i (words) gets min(2 s_i, λ w_i), with λ such that the targets
add up to the wanted share of all words. Sources are ordered by code point, null last, and the weights repeat.

Curriculum: each source has a piecewise linear weight schedule over training time 0..1. Its integral,
scaled to the source's target, is the source's cumulative demand; a copy of a document that covers the
source's words a..b is placed where the demand reaches (a + b) / 2, the inverse of the integral. The
documents of a source follow each other in md5 order of their id; the second epoch repeats that order.

Prefix sums are two-level: documents fall in slices of the md5 order, windows run inside a slice of a
source, and one row per slice carries the offset, so no source is ever gathered in one task.

A null text has no words and is never taken in cut mode; a null source is a source of its own; equal
rows are separate documents; rows that differ only in the text follow each other by its hash. An empty
table gives an empty mix. Columns of the input named like the result's are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regmill.llm.registry import WORD, documents, query
from regmill.session import written

WEIGHTS = (5, 2, 1)
# Weights at equal distances of training time; sources take them in turn.
SCHEDULES = ((1.0, 1.0, 1.0), (2.0, 1.0, 0.5), (0.5, 1.0, 2.0))
SLICE_DIGITS = 3


def sized(docs: DataFrame, id: str, text: str, source: str) -> DataFrame:
    """id, source, size in words and the order key of every row."""
    return docs.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")).alias("key"),
        F.xxhash64(F.col(text)).alias("tie"),
    )


def source_targets(rows: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """source, source_size, target and turn (place in the order of sources), one row per source.

    λ: with sources ordered by most * size / weight, the first at which the words left, shared by the
    weights left, stay within that ratio.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    table = (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("turn", F.row_number().over(by_name) - 1)
        .withColumn("weight", cycle[F.col("turn") % len(weights)])
        .withColumn("cap", F.col("source_size") * float(most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    everything = Window.partitionBy()
    rising = Window.orderBy("ratio", "turn").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(rising), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0))
    table = table.withColumn("level", left / weight_left)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "turn", "level"))).over(everything)
    return table.withColumn("level", level["level"]).select(
        "source",
        "source_size",
        "turn",
        F.when(F.col("ratio") <= F.col("level"), F.col("cap"))
        .otherwise(F.least("cap", F.col("level") * F.col("weight")))
        .alias("target"),
    )


def training_time(done: Column, turn: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """The time 0..1 at which the integral of the source's schedule is the share `done` of its whole.

    On a segment the integral is a quadratic; its root is written so that nothing cancels.
    """
    result = F.lit(None).cast("double")
    for place, knots in enumerate(schedules):
        width = 1.0 / (len(knots) - 1)
        area = [(a + b) / 2 * width for a, b in zip(knots, knots[1:], strict=False)]
        total, before, here = sum(area), 0.0, None
        for k, (a, b) in enumerate(zip(knots, knots[1:], strict=False)):
            rest = done * total - before
            slope = (b - a) / width
            root = a + F.sqrt(F.greatest(F.lit(a * a) + 2 * slope * rest, F.lit(0.0)))
            at = F.when(root > 0, 2 * rest / root).otherwise(0.0) + k * width
            before += area[k]
            last = k == len(area) - 1
            here = F.when(done * total <= before, at) if here is None else here.when(done * total <= before, at)
            here = here.otherwise(at) if last else here
        result = F.when(turn % len(schedules) == place, F.least(here, F.lit(1.0))).otherwise(result)
    return result


def mix_plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    share: float = 1.5,
    most: int = 2,
    cut: bool = True,
) -> DataFrame:
    """One row per document: id, source, size, tie, source_size, target, copies.

    `copies` lists the copies that the mix takes: copy (its epoch), taken (words) and position, the inverse of the
    source's demand at the middle of those words. With `cut` the copy in
    which the target is reached is taken up to that word, so a source's words equal its rounded target;
    without, copies are whole and taken while their middle lies before the target.
    """
    rows = written(sized(docs, id, text, source), "sized")
    table = source_targets(rows, weights, share, most)
    rows = rows.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("slice_at", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
    slices = (
        slices.alias("a")
        .join(table.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
        .select("a.source", "slice", "slice_at", "source_size", "target", "turn")
    )
    inside = (
        Window.partitionBy("source", "slice")
        .orderBy("key", "id", "tie", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        rows.alias("a")
        .join(
            slices.alias("b"),
            F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.slice") == F.col("b.slice")),
        )
        .select("a.*", "slice_at", "source_size", "target", "turn")
        .withColumn("at", F.col("slice_at") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    )

    def copy(number: Column) -> Column:
        start = number * F.col("source_size") + F.col("at")
        if cut:
            rest = F.round(F.col("target")).cast("long") - start
            taken = F.least(F.col("size"), F.greatest(rest, F.lit(0)))
        else:
            taken = F.when(start + F.col("size") / 2 <= F.col("target"), F.col("size"))
        done = F.least((start + taken / 2) / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0))
        return F.struct(
            number.cast("int").alias("copy"),
            taken.cast("long").alias("taken"),
            training_time(done, F.col("turn"), schedules).alias("position"),
        )

    copies = F.transform(F.array(*[F.lit(k) for k in range(most)]), copy)
    wanted = (lambda c: c["taken"] > 0) if cut else (lambda c: c["taken"].isNotNull())
    return placed.select(
        "id", "source", "size", "tie", "source_size", "target", F.filter(copies, wanted).alias("copies")
    )


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The documents of the mix, whole, in training order: one row per copy taken, all columns of `docs`."""
    plan = mix_plan(docs, id, text, source, cut=False, **options)
    copies = plan.select(
        F.col("id").alias("_id"), F.col("tie").alias("_tie"), F.inline("copies").alias("_copy", "_taken", "_position")
    )
    # equal rows have equal plans but for their places: number them on both sides
    same = Window.partitionBy("_id", "_tie", "_copy").orderBy("_position")
    copies = copies.withColumn("_n", F.row_number().over(same)).select("_id", "_tie", "_n", "_position")
    names = docs.columns
    tagged = docs.select(
        F.struct(*names).alias("_doc"), F.col(id).alias("_id"), F.xxhash64(F.col(text)).alias("_tie")
    )
    tagged = tagged.withColumn(
        "_n", F.row_number().over(Window.partitionBy("_id", "_tie").orderBy(F.monotonically_increasing_id()))
    )
    joined = tagged.alias("a").join(
        copies.alias("b"),
        F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._tie") == F.col("b._tie")) & (F.col("a._n") == F.col("b._n")),
    )
    ordered = joined.select("_doc", "_position").repartitionByRange("_position").sortWithinPartitions("_position")
    return ordered.select("_doc.*")



SQL = """
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS turn
  FROM rows GROUP BY source),
capped AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][(turn % 3 + 1)::INT] AS weight, source_size * 2.0::DOUBLE AS cap FROM named),
levels AS (
  SELECT *, cap / weight AS ratio,
         ((sum(source_size) OVER ()) * 1.5::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((sum(weight) OVER ())
          - coalesce(sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM capped),
found AS (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, turn LIMIT 1),
targets AS (
  SELECT source, source_size,
         CASE WHEN ratio <= (SELECT level FROM found) THEN cap
              ELSE least(cap, (SELECT level FROM found) * weight) END AS target, turn FROM levels),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, t.turn,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, [1.0::DOUBLE, 2.0, 0.5][(turn % 3 + 1)::INT] AS a, 1.0::DOUBLE AS b, [1.0::DOUBLE, 0.5, 2.0][(turn % 3 + 1)::INT] AS c,
         least(size, greatest(round(target)::BIGINT - begins, 0))::BIGINT AS taken_1,
         least(size, greatest(round(target)::BIGINT - source_size - begins, 0))::BIGINT AS taken_2 FROM placed),
demand AS (
  SELECT *, (a + b) / 4 AS half,
         least((begins + taken_1 / 2) / greatest(target, 1), 1) * (a + 2 * b + c) / 4 AS area_1,
         least((source_size + begins + taken_2 / 2) / greatest(target, 1), 1) * (a + 2 * b + c) / 4 AS area_2 FROM copies)
SELECT doc_id, size, source_size, target, (taken_1 + taken_2)::BIGINT AS taken,
       CASE WHEN taken_1 > 0 THEN round(CASE
         WHEN area_1 <= half THEN 2 * area_1 / (a + sqrt(greatest(a * a + 4 * (b - a) * area_1, 0)))
         ELSE 0.5 + 2 * (area_1 - half) / (b + sqrt(greatest(b * b + 4 * (c - b) * (area_1 - half), 0))) END, 9)::DOUBLE END AS position_1,
       CASE WHEN taken_2 > 0 THEN round(CASE
         WHEN area_2 <= half THEN 2 * area_2 / (a + sqrt(greatest(a * a + 4 * (b - a) * area_2, 0)))
         ELSE 0.5 + 2 * (area_2 - half) / (b + sqrt(greatest(b * b + 4 * (c - b) * (area_2 - half), 0))) END, 9)::DOUBLE END AS position_2
FROM demand
"""


@query("op6_mixing", SQL)
def op6(spark, sf_dir):
    plan = mix_plan(documents(spark, sf_dir))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda total, c: total + c["taken"])

    def position(copy: int) -> Column:
        own = F.get(F.filter("copies", lambda c: c["copy"] == copy), F.lit(0))["position"]
        return F.round(own, 9).alias(f"position_{copy + 1}")

    columns = [F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"), position(0), position(1)]
    # documents by the first place they are trained at; those that are never trained come last, spread by their id
    at = [F.coalesce("position_1", "position_2", F.lit(2.0)), F.xxhash64("doc_id")]
    return plan.select(*columns).repartitionByRange(*at).sortWithinPartitions(*at)
