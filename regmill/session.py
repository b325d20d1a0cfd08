"""Session construction and the one shared scratch location jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from regmill.operators import folders

CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def local_session(cores: str = "8", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitted session is used as is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("regmill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="regmill-", dir="/tmp")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; Spark creates it on first write."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


class Scratch:
    """Tables that `written` made while this was open; `drop` deletes them once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def drop(self) -> None:
        while self.paths:
            folders.delete(self.spark, self.paths.pop())


_open: list[Scratch] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Notes the tables written inside, so that their owner can drop them when its result has been stored."""
    noted = Scratch(spark)
    _open.append(noted)
    try:
        yield noted
    finally:
        _open.remove(noted)


def written(df: DataFrame, label: str, files: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: computed once, kept when executors are lost.

    With `files`, in at most so many of them: the last stage's partitions are joined, without a shuffle. For tables of few
    and short rows, whose number the caller can bound: to write a file costs more than such rows do (Hadoop's local
    file system starts several processes for each).
    """
    path = fresh_dir(df.sparkSession, label)
    for noted in _open:
        noted.paths.append(path)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
