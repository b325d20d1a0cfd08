"""Plans that stay balanced when one key holds a large share of the rows.

Hints are given only for tables that are small by construction (Bloom filters, bounds and carries): Spark broadcasts a side whose size it knows
(rule rows are local relations, tables have file sizes) or has measured (adaptive execution),
and runs anything larger as a shuffled equi-join whose oversized partitions it splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_by(df: DataFrame, keys: list[str], order: list[Column], most: int = 1) -> DataFrame:
    """One row per key (or the first few), the least in `order` (which must not tie).

    Spark turns rank <= most into a per-task limit before the shuffle, so a hot key
    sends that many rows per map task and no group is ever gathered.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= most).drop("_rank")


def deal_out(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt out over a number of partitions by a unique key: for work per row on a file that cannot be split."""
    return df.repartition(partitions, key)
