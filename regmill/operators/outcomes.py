"""Good rows, rejects and their counts from one job: the counts are taken while the rows are written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OUTCOME, GOOD = "outcome", "good"


@dataclass(frozen=True)
class Outcomes:
    """Both parts of a load as tables and how many rows went where."""

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]


def mark(df: DataFrame, checks: dict[str, Column], held: Column | None = None) -> DataFrame:
    """Rows with their outcome: the first check that they fail, `already held`, or `good`. A null check fails."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    known = [] if held is None else [F.when(F.coalesce(held, F.lit(False)), F.lit("already held"))]
    return df.withColumn(OUTCOME, F.coalesce(*failed, *known, F.lit(GOOD)))


def write_outcomes(
    df: DataFrame, root: str, checks: dict[str, Column], held: Column | None = None, format: str = "parquet"
) -> Outcomes:
    """Write all rows, each in the folder of its outcome, and count the outcomes in the same job.

    The counters sit right below the writer, in its last stage: there Spark adds a task's figures once, however often
    the task had to run. Outcomes without a row count 0. An empty table gives empty parts.
    """
    if OUTCOME in df.columns:
        raise ValueError(f"a column is named {OUTCOME}")
    names = [*checks, *([] if held is None else ["already held"]), GOOD]
    if len(set(names)) < len(names):
        raise ValueError(f"checks may not be named {GOOD!r} or 'already held'")
    marked = mark(df, checks, held)
    seen = Observation()
    counters = [F.count_if(F.col(OUTCOME) == name).alias(f"n{i}") for i, name in enumerate(names)]
    marked.observe(seen, *counters).write.partitionBy(OUTCOME).format(format).save(root)
    counts = {name: seen.get[f"n{i}"] for i, name in enumerate(names)}
    rows = df.sparkSession.read.schema(marked.schema).format(format).load(root)
    good = rows.where(F.col(OUTCOME) == GOOD).drop(OUTCOME)
    bad = rows.where(F.col(OUTCOME) != GOOD).withColumnRenamed(OUTCOME, "reason")
    return Outcomes(good, bad, counts)
