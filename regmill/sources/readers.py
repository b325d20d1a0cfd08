"""Batch readers. Each names its columns, so scans read only what is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regmill.operators import folders
from regmill.operators.scale import deal_out


def scan_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Fetched pages that have content; a stored status other than 200 means there is none.

    The file layout decides the partitions unless a number of them is asked for, which moves whole pages.
    """
    pages = spark.read.parquet(path)
    usable = F.col("html").isNotNull()
    if "status" in pages.columns:
        usable = usable & (F.col("status") == 200)
    pages = pages.where(usable)
    return pages if partitions is None else deal_out(pages, "url", partitions)


def scan_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """API responses, one JSON value per line, decoded by a given schema."""
    return spark.read.schema(schema).json(path)


def decode_json(df: DataFrame, column: str, schema: StructType | str, into: str = "body") -> DataFrame:
    """The same for responses held in a column; text that is no JSON becomes null."""
    return df.withColumn(into, F.from_json(F.col(column), schema))


def scan_csv(spark: SparkSession, path: str, columns: list[str], line_breaks: bool = True) -> DataFrame:
    """Columns of a delimited file picked by header name, wherever they stand.

    Quoted values may hold line breaks, so a file is one split; without them files can be split.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks)
    return reader.csv(path).select(*columns)


def scan_table_rows(
    spark: SparkSession, path: str, doc: str = "doc", table_no: str = "table_no", row_no: str = "row_no"
) -> DataFrame:
    """Rows of extracted tables with their place (document, table, row)."""
    rows = spark.read.parquet(path)
    return rows.withColumnsRenamed({doc: "doc", table_no: "table_no", row_no: "row_no"})


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files held below a folder; contents are never read, because only path and length are selected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(
        "path", "length", F.substring_index("path", "/", -1).alias("file_name")
    )


def scan_held(spark: SparkSession, root: str) -> DataFrame:
    """Files held below a folder with their place: site, category, year, file_name, path and length.

    Folders may be named (`category=a/year=2020`, any of the three, in any order) or plain: `site/[category/][year/]file`, where
    a last folder of four digits is the year and what lies between it and the site is the category. Parts that a
    path lacks are null, as is the value that Spark's writer gives to nulls.
    """
    below = F.substring("path", len(folders.qualified(spark, root).rstrip("/")) + 2, 1 << 30)
    files = scan_manifest(spark, root).withColumn("_dirs", F.slice(F.split(below, "/"), 1, F.size(F.split(below, "/")) - 1))
    plain = F.filter("_dirs", lambda d: ~F.contains(d, F.lit("=")))
    files = files.withColumn("_plain", plain)
    last = F.get("_plain", F.size("_plain") - 1)
    dated = (F.size("_plain") > 0) & F.coalesce(last.rlike("^[0-9]{4}$"), F.lit(False))
    rest = F.when(dated, F.slice("_plain", 1, F.size("_plain") - 1)).otherwise(F.col("_plain"))
    between = F.when(F.size(rest) > 1, F.array_join(F.slice(rest, 2, F.size(rest)), "/"))

    def named(name: str):
        value = F.get(F.filter("_dirs", lambda d: F.startswith(d, F.lit(f"{name}="))), F.lit(0))
        value = F.substring(value, len(name) + 2, 1 << 30)
        value = F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)
        return F.when(value != "__HIVE_DEFAULT_PARTITION__", value)

    return files.select(
        F.coalesce(named("site"), F.get(rest, F.lit(0))).alias("site"),
        F.coalesce(named("category"), between).alias("category"),
        F.coalesce(named("year"), F.when(dated, last)).alias("year"),
        "file_name",
        "path",
        "length",
    )
