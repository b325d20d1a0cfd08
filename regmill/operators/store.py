"""Keyed document tables on plain Parquet.

Writes are appended as one folder per source, load and batch. A load costs what its batch holds, a
replayed batch replaces its own folder and no other one, and readers take the last write of each id.

    root/source=<name>/load=<number>/batch=<number>   writes as they came
    root/_versions/<number>-<token>                   the index at a compaction, sorted by key
    root/_pointers/<number>-<token>                   its folder, and the write folders that are in it

A compaction merges the last version with the writes since; readers take the newest version that has a pointer and the
writes that the pointer does not name. So an index is read from one version and few folders, however many loads it has had.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from regmill.operators import folders
from regmill.operators.ordered import CHUNK, running_count
from regmill.operators.scale import first_by

ROWS_PER_FILE = 1_000_000


def last_write(batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return first_by(batch, key, [F.col(c).desc() for c in order])


def upsert(target: DataFrame, batch: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Target, one row per id, after the batch: a written id replaces the held one, the last write of the batch wins.

    Null ids are one id. The batch is ranked once and meets the target in one outer join.
    """
    new = last_write(batch, key, order).select(F.struct(*target.columns).alias("new"))
    held = target.select(F.struct(*target.columns).alias("held"))
    same = reduce(lambda a, b: a & b, [F.col(f"held.{c}").eqNullSafe(F.col(f"new.{c}")) for c in key])
    both = held.join(new, same, "full_outer").select(F.coalesce("new", "held").alias("row"))
    return both.select("row.*")


def write_versions(writes: DataFrame, key: list[str], order: list[str], chunk: int = CHUNK) -> DataFrame:
    """Each write with its version: the how-manieth write of its id. Versions above 1 are the audit."""
    return running_count(writes, F.lit(True), key, order, "version", inclusive=True, chunk=chunk)


PLACE = ["load", "batch", "source"]


def batch_folder(root: str, batch_id: int, load: int, source: str) -> str:
    return f"{root}/source={folders.as_folder(source)}/load={load}/batch={batch_id}"


def append_batch(batch: DataFrame, root: str, batch_id: int, load: int = 0, source: str = "main") -> None:
    """Write one batch of a load; loads are numbered in the order in which later writes win."""
    batch.write.mode("overwrite").parquet(batch_folder(root, batch_id, load, source))


def next_load(spark: SparkSession, root: str) -> int:
    """The number after the last load of any source; 0 for a new index. Only folder names are read."""
    last = folders.last_load(spark, root)
    return 0 if last is None else last + 1


def _name_of(folder: str) -> str:
    """source=/load=/batch= of a write's folder, which names it wherever the root is."""
    return "/".join(folder.rsplit("/", 3)[1:])


def _pointer(spark: SparkSession, root: str) -> tuple[str | None, set[str]]:
    """The newest version's folder and the names of the writes in it."""
    found = folders.found(spark, f"{root}/_pointers/*")
    if not found:
        return None, set()
    newest = max(found, key=lambda p: (int(p.rpartition("/")[2].partition("-")[0]), p))
    held = json.loads(folders.text_of(spark, newest))
    return f"{root}/_versions/{held['version']}", set(held["writes"])


def pending_writes(spark: SparkSession, root: str) -> list[str]:
    """Committed write folders that no version holds."""
    _, held = _pointer(spark, root)
    return [p for p in folders.committed(spark, f"{root}/source=*/load=*/batch=*") if _name_of(p) not in held]


def has_writes(spark: SparkSession, root: str) -> bool:
    return bool(folders.found(spark, f"{root}/_pointers/*") or pending_writes(spark, root))


def read_writes(spark: SparkSession, root: str, only: list[str] | None = None) -> DataFrame:
    """All writes (or those of some folders) with their place: load, batch, source."""
    paths = folders.committed(spark, f"{root}/source=*/load=*/batch=*") if only is None else only
    found = spark.read.option("basePath", root).parquet(*(paths or [f"{root}/source=*/load=*/batch=*"]))
    return found.withColumn("source", F.col("source").cast("string"))


def _all_rows(spark: SparkSession, root: str) -> DataFrame:
    """The newest version and the writes since."""
    version, held = _pointer(spark, root)
    pending = pending_writes(spark, root)
    if version is None:
        return read_writes(spark, root, pending)
    merged = spark.read.parquet(version)
    return merged.unionByName(read_writes(spark, root, pending)) if pending else merged


def read_index(spark: SparkSession, root: str, key: list[str], order: list[str]) -> DataFrame:
    """Current documents: the last write per id over all loads and batches."""
    return last_write(_all_rows(spark, root), key, [*PLACE[:2], *order, PLACE[2]])


def compact(spark: SparkSession, root: str, key: list[str], order: list[str]) -> str | None:
    """Merge the last version and the writes since into a new version, sorted by key; None if there were none.

    The pointer is one small file, created when the version is complete. Until then, and if this job dies, readers
    go on with the version before. Two compactions at a time each name what is in their own version.
    """
    _, held = _pointer(spark, root)
    pending = pending_writes(spark, root)
    if not pending:
        return None
    numbers = [int(p.rpartition("/")[2].partition("-")[0]) for p in folders.found(spark, f"{root}/_pointers/*")]
    number, name = max(numbers, default=-1) + 1, uuid.uuid4().hex
    version = f"{number}-{name}"
    index = read_index(spark, root, key, order)
    index.repartitionByRange(*key).sortWithinPartitions(*key).write.parquet(f"{root}/_versions/{version}")
    # names of folders that were removed since are of no use any more
    there = {_name_of(p) for p in folders.found(spark, f"{root}/source=*/load=*/batch=*")}
    writes = sorted((held & there) | {_name_of(p) for p in pending})
    folders.create_once(spark, f"{root}/_pointers/{version}", json.dumps({"version": version, "writes": writes}))
    return version


def compact_after(spark: SparkSession, root: str, key: list[str], order: list[str], writes: int) -> str | None:
    """Compact once that many write folders are not in a version: reads then open fewer than that and one version."""
    return compact(spark, root, key, order) if len(pending_writes(spark, root)) >= writes else None


def expire(spark: SparkSession, root: str, versions: int = 2) -> int:
    """Delete versions but the newest ones, and writes that the oldest version kept holds; how many folders went.

    A replayed batch that comes back later is ignored while a kept pointer names it; readers of versions that go must be done.
    """
    place = lambda p: (int(p.rpartition("/")[2].partition("-")[0]), p)
    pointers = sorted(folders.found(spark, f"{root}/_pointers/*"), key=place)
    gone = 0
    if len(pointers) >= versions:
        held = set(json.loads(folders.text_of(spark, pointers[-versions]))["writes"])
        for path in folders.found(spark, f"{root}/source=*/load=*/batch=*"):
            if _name_of(path) in held:
                folders.delete(spark, path)
                gone += 1
    for path in pointers[:-versions]:
        folders.delete(spark, path)
        folders.delete(spark, f"{root}/_versions/{path.rpartition('/')[2]}")
        gone += 1
    return gone


def append_random_id(df: DataFrame, into: str = "document_id") -> DataFrame:
    """Ids that differ on every run, so a repeated load repeats its rows."""
    return df.withColumn(into, F.expr("uuid()"))


def spread(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows dealt out by output folder; adaptive execution measures the folders, splits the large and joins the small.

    Without it every task would write a file into every folder. Rows of a file come in the given order.
    """
    return df.hint("rebalance", *[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)


def adding_files(df: DataFrame, keys: list[str], order: list[str], rows_per_file: int) -> DataFrameWriter:
    """Writer that adds files to the folders the rows fall into; whatever lies there stays."""
    parts = spread(df, keys, order).write.mode("append").partitionBy(*keys)
    return parts.option("maxRecordsPerFile", rows_per_file)


def write_csv_by(df: DataFrame, root: str, key: str, order: list[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Headerless delimited files, one folder per key value; earlier rows of a key stay."""
    adding_files(df, [key], order, rows_per_file).option("escape", '"').csv(root, header=False)


def write_layout(
    df: DataFrame, root: str, keys: list[str], order: list[str], rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Rows laid out by site, category and year, so that reads of one of them open its folders only.

    Rows are added; loads that may be started again go through `layout.write_load`, which tells them apart.
    """
    adding_files(df, keys, order, rows_per_file).parquet(root)


def write_bundles(
    files: DataFrame, root: str, key: str, path: str, codec: str = "gzip", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """The bundled files, one compressed folder per key."""
    adding_files(files, [key], [path], rows_per_file).option("compression", codec).parquet(root)


def bundle(files: DataFrame, key: str, length: str, prefix: str = "DEF_14A/") -> DataFrame:
    """Address, number of files and bytes of each key's bundle; a key without files has none."""
    return (
        files.groupBy(key)
        .agg(F.count("*").alias("n_files"), F.sum(length).cast("bigint").alias("bytes"))
        .withColumn("address", F.concat(F.lit(prefix), F.col(key)))
    )


def ensure_target(spark: SparkSession, name: str, schema: str, location: str | None = None) -> str:
    """Create a table if it is absent, under its lower-case name; an existing one is left as it is."""
    name = name.lower()
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{place}")
    return name


def union_collections(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all collections, repeats kept."""
    for other in others:
        first = first.unionByName(other)
    return first
