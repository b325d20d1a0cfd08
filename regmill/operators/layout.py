"""Append-only layouts of files by place (site, category, year), with a manifest that is committed last.

    root/_loads/<number>        the claim of a load: its token
    root/data/load=<number>/…   the rows that the load adds, in folders of their place
    root/manifest/load=<number> a row per file of the load: place, name, the data file that holds it and its size

A load writes its data, then its manifest; only loads with a manifest are seen. Nothing that another load wrote
is touched. A load that died before its manifest starts over in its own folder, one that ran to the end is left alone
when it is started again. Which of several rows of one file is shown follows from the order of the loads: the first for
files that are fetched once, the last for texts that are written anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.window import Window

from regmill.operators import folders
from regmill.operators.scale import first_by
from regmill.operators.store import ROWS_PER_FILE, spread

FIRST, LAST = "first", "last"


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _without(rows: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that `other` does not have; nulls are equal."""
    return rows.alias("r").join(other.select(*columns).alias("o"), _same("r", "o", columns), "left_anti")


def manifest_schema(place: list[StructField], name: str) -> StructType:
    fields = [*place, StructField(name, StringType()), StructField("path", StringType()), StructField("size", LongType())]
    return StructType([*fields, StructField("load", LongType())])


def manifest(spark: SparkSession, root: str, place: list[StructField], name: str, before: int | None = None) -> DataFrame:
    """place, name, path, size and load of every file of the committed loads (those before a number)."""
    schema = manifest_schema(place, name)
    loads = folders.committed(spark, f"{root}/manifest/load=*")
    loads = [p for p in loads if before is None or folders.value_in(p, "load") < before]
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/manifest").parquet(*loads)


def _place_fields(files: DataFrame, place: list[str]) -> list[StructField]:
    return [StructField(c, files.schema[c].dataType) for c in place]


def write_load(
    files: DataFrame,
    root: str,
    token: str,
    place: list[str],
    name: str,
    order: list[str],
    wins: str = FIRST,
    rows_per_file: int = ROWS_PER_FILE,
    format: str = "parquet",
    **options: str,
) -> int:
    """Add the files (place, name and any further columns) as one load; the load's number.

    Of rows of one file in the load the first (last) by `order` goes in. With `wins` first, files that an
    earlier load has are left out before anything is written.
    """
    spark = files.sparkSession
    number = folders.claim_load(spark, root, token)
    done, data = f"{root}/manifest/load={number}", f"{root}/data/load={number}"
    if folders.committed(spark, done):
        return number
    key = [*place, name]
    turn = (lambda c: F.col(c).asc()) if wins == FIRST else (lambda c: F.col(c).desc())
    rows = first_by(files, key, [turn(c) for c in order])
    if wins == FIRST:
        rows = _without(rows, manifest(spark, root, _place_fields(files, place), name, number), key)
    writer = spread(rows, place, [name]).write.mode("overwrite").partitionBy(*place).format(format)
    writer.option("maxRecordsPerFile", rows_per_file).options(**options).save(data)
    added = spark.read.schema(rows.schema).format(format).options(**options).load(data)
    source = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    added.select(*place, F.col(name).cast("string").alias(name), *source).write.mode("overwrite").parquet(done)
    return number


def read_layout(
    spark: SparkSession,
    root: str,
    schema: StructType,
    place: list[str],
    name: str,
    wins: str = FIRST,
    format: str = "parquet",
    **options: str,
) -> DataFrame:
    """The rows of the layout with the number of their load: one row per file.

    Losing rows are found in the manifest, which holds no contents, and only they are matched with the data; a filter
    on the place reaches the folders.
    """
    full = StructType([*schema.fields, StructField("load", LongType())])
    loads = [folders.value_in(p, "load") for p in folders.committed(spark, f"{root}/manifest/load=*")]
    if not loads:
        return spark.createDataFrame([], full)
    paths = [f"{root}/data/load={n}" for n in loads]
    data = spark.read.schema(full).format(format).options(**options).option("basePath", f"{root}/data").load(paths)
    held = manifest(spark, root, [schema[c] for c in place], name)
    turn = F.col("load").asc() if wins == FIRST else F.col("load").desc()
    ranked = held.withColumn("rank", F.row_number().over(Window.partitionBy(*place, name).orderBy(turn)))
    lost = ranked.where("rank > 1").withColumn(name, F.col(name).cast(schema[name].dataType))
    return _without(data, lost, [*place, name, "load"]).select(*full.names)


def unfinished(spark: SparkSession, root: str) -> list[int]:
    """Loads with data and no manifest: still running, or to be started again under their token."""
    written = {folders.value_in(p, "load") for p in folders.found(spark, f"{root}/data/load=*")}
    return sorted(written - {folders.value_in(p, "load") for p in folders.committed(spark, f"{root}/manifest/load=*")})
