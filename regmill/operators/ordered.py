"""Order-dependent steps without one task per group.

A window partitioned by site would put a site's whole history into one task. Here a
group is cut into chunks of its order: windows run inside chunks, one summary row per chunk carries
the state across them, and the carry is joined back on the group key and the chunk.

Rows move once, to their chunk. Bounds are one in `chunk` rows, and only groups that hold one have summary rows, at most
two a bound; both tables are that much smaller than the input and are sent to the rows.

Chunks start at rows of the group itself, chosen by a hash of their order columns: one row in `chunk`, and of these
the ones of least hash, at most BOUNDS a group. So chunks follow the rows however their order values are spread, a
group of few rows is one chunk, and a job that is started again cuts alike. A group has at most BOUNDS + 1 summary rows.

Null group keys are equal: their rows are one group, as in a window. Order columns are of any type that sorts; rows that
agree in all of them lie in one chunk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regmill.operators.scale import first_by

CHUNK = 1 << 14
BOUNDS = 255


def _sent(small: DataFrame, by: list[str]) -> DataFrame:
    """A table of bounds or of their summaries, its keys renamed for `_same`: one row in thousands, so rows need not move."""
    return F.broadcast(small.withColumnsRenamed({c: f"_of_{c}" for c in by}))


def _same(by: list[str]) -> Column:
    """Nulls are equal here."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])


def _chunked(df: DataFrame, by: list[str], order: list[str], chunk: int) -> DataFrame:
    """Rows with the number of their chunk (how many bounds of their group lie at or before them), and whether it has any."""
    place, mark = F.struct(*order), F.xxhash64(*by, *order)
    some = df.where(F.pmod(mark, F.lit(chunk)) == 0).select(*by, place.alias("_place"), mark.alias("_mark")).distinct()
    some = first_by(some, by, [F.col("_mark"), F.col("_place")], most=BOUNDS)
    bounds = some.groupBy(*by).agg(F.sort_array(F.collect_list("_place")).alias("_bounds"))
    # halving steps, as a hot group has all its bounds to search for every row
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(BOUNDS.bit_length()))])
    step_on = lambda at, step: F.when(F.get("_bounds", at + step - 1) <= place, at + step).otherwise(at)
    passed = F.aggregate(steps, F.lit(0), step_on)
    cut = F.col("_bounds").isNotNull()
    chunked = df.join(_sent(bounds, by), _same(by), "left")
    return chunked.select(*df.columns, F.when(cut, passed).otherwise(0).alias("_chunk"), cut.alias("_cut"))


def _inside(by: list[str], order: list[str]):
    return Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _chunks_before(by: list[str]):
    return Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)


def _carried(rows: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    """Rows with the carry of their chunk, null where the group is one chunk."""
    keys = [*by, "_chunk"]
    return rows.join(_sent(carry, keys), _same(keys), "left").drop(*[f"_of_{c}" for c in keys])


def forward_fill(
    df: DataFrame, value: str, by: list[str], order: list[str], into: str, chunk: int = CHUNK
) -> DataFrame:
    """Most recent non-null `value` up to and including each row, per group."""
    rows = _chunked(df, by, order, chunk)
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = rows.where("_cut").groupBy(*by, "_chunk").agg(F.max_by(F.col(value), place).alias("_end"))
    carry = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(_chunks_before(by))).drop("_end")
    filled = rows.withColumn("_last", F.last(value, ignorenulls=True).over(_inside(by, order)))
    out = _carried(filled, carry, by).withColumn(into, F.coalesce("_last", "_carry"))
    return out.select(*df.columns, into)


def _counted(df: DataFrame, flag: Column, by: list[str], order: list[str], chunk: int) -> DataFrame:
    """Rows with their chunk, the flags before them in the group and the group's flags in all."""
    rows = _chunked(df.withColumn("_flag", F.when(flag, 1).otherwise(0).cast("long")), by, order, chunk)
    sums = rows.where("_cut").groupBy(*by, "_chunk").agg(F.sum("_flag").alias("_sum"))
    carry = sums.select(
        *by,
        "_chunk",
        F.sum("_sum").over(_chunks_before(by)).alias("_carry"),
        F.sum("_sum").over(Window.partitionBy(*by)).alias("_all"),
    )
    here = _inside(by, order)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = rows.select("*", F.sum("_flag").over(here).alias("_seen"), F.sum("_flag").over(whole).alias("_own"))
    out = _carried(seen, carry, by)
    before = F.coalesce("_carry", F.lit(0).cast("long")) + F.col("_seen") - F.col("_flag")
    counted = out.withColumns({"_before": before, "_total": F.coalesce("_all", "_own")})
    return counted.drop("_carry", "_all", "_seen", "_own", "_cut")


def running_count(
    df: DataFrame, flag: Column, by: list[str], order: list[str], into: str, inclusive: bool, chunk: int = CHUNK
) -> DataFrame:
    """How many flagged rows came earlier in the group (this row counted when inclusive)."""
    out = _counted(df, flag, by, order, chunk)
    count = F.col("_before") + F.col("_flag") if inclusive else F.col("_before")
    return out.withColumn(into, count).select(*df.columns, into)


def _joined_in_order(place: Column, text: Column) -> Column:
    held = F.collect_list(F.when(text.isNotNull(), F.struct(place.alias("at"), text.alias("text"))))
    return F.array_join(F.transform(F.sort_array(held), lambda x: x["text"]), "")


def assemble_records(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    pieces: dict[str, Column],
    closes: Column,
    closing: dict[str, Column],
    chunk: int = CHUNK,
) -> DataFrame:
    """Text pieces gathered over rows until a closing row ends the record.

    The closing row's own pieces belong to the record it closes. Rows after the last
    closing row of a group form no record and are left out before anything is gathered.
    Texts are joined per chunk first, where rows already lie together, and chunk texts
    are joined after that, so a long record does not gather its single rows.
    """
    counted = _counted(rows, closes, by, order, chunk).where(F.col("_before") < F.col("_total"))
    ends = [F.max(F.when(F.col("_flag") == 1, value)).alias(name) for name, value in closing.items()]
    parts = counted.groupBy(*by, "_chunk", "_before").agg(
        *[_joined_in_order(F.struct(*order), piece).alias(name) for name, piece in pieces.items()], *ends
    )
    return (
        parts.groupBy(*by, "_before")
        .agg(
            *[_joined_in_order(F.col("_chunk"), F.col(name)).alias(name) for name in pieces],
            *[F.max(name).alias(name) for name in closing],
        )
        .withColumnRenamed("_before", "record_no")
    )


def first_seen(df: DataFrame, key: list[str], scope: list[str], order: list[str]) -> DataFrame:
    """First occurrence of each key within its scope (a run, or a year when lists are cleared yearly)."""
    return first_by(df, [*scope, *key], [F.col(c) for c in order])


def high_water(index: DataFrame, by: list[str], title: str, order: list[str]) -> DataFrame:
    """Title of the first row of the index per source: the point already reached."""
    return first_by(index.select(*by, title, *order), by, [F.col(c) for c in order]).select(
        *by, F.col(title).alias("mark")
    )


def since_mark(listing: DataFrame, marks: DataFrame, by: list[str], title: str, pos: str) -> DataFrame:
    """Newest-first listing rows in front of the marked title; all rows when the mark is absent.

    The cut is the least position of the mark, a combinable minimum, instead of a running flag over the
    listing of a source. It is one row per source: Spark broadcasts it or splits a source's oversized partition.
    """
    hits = listing.select(*by, title, pos).join(marks.withColumnRenamed("mark", title), [*by, title])
    reached = hits.groupBy(*by).agg(F.min(pos).alias("_reached"))
    return (
        listing.join(reached, by, "left")
        .where(F.col("_reached").isNull() | (F.col(pos) < F.col("_reached")))
        .select(*listing.columns)
    )


def count_by(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))
