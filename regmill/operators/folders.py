"""Folder names of a store, listed without opening files, and small files that are created once.

A folder counts as committed when Spark's writer has left its success mark there. What is listed are folders of loads and
batches, never single data files, so the driver sees as many names as a store has had writes.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MARK = "_SUCCESS"


def _file_system(spark: SparkSession, place: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def qualified(spark: SparkSession, place: str) -> str:
    """The place with its file system, as Spark's readers name files below it."""
    files, path = _file_system(spark, place)
    return files.makeQualified(path).toString()


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order; none if nothing does."""
    files, path = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or ())


def committed(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a pattern and were written to the end."""
    return [path.removesuffix(f"/{MARK}") for path in found(spark, f"{pattern}/{MARK}")]


def exists(spark: SparkSession, place: str) -> bool:
    files, path = _file_system(spark, place)
    return files.exists(path)


def delete(spark: SparkSession, place: str) -> None:
    files, path = _file_system(spark, place)
    files.delete(path, True)


def create_once(spark: SparkSession, place: str, text: str) -> bool:
    """Write a small file unless it is there; whether this call wrote it."""
    files, path = _file_system(spark, place)
    try:
        out = files.create(path, False)
    except Py4JJavaError:
        if files.exists(path):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def text_of(spark: SparkSession, place: str) -> str:
    files, path = _file_system(spark, place)
    size = int(files.getFileStatus(path).getLen())
    stream = files.open(path)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()


def value_in(path: str, name: str) -> int:
    """The number behind name= in a path."""
    return int(re.search(rf"(?:^|/){name}=(\d+)(?:/|$)", path)[1])


def as_folder(value: str) -> str:
    """A text as part of a folder's name; Spark's readers turn it back."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{}\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value) or "__HIVE_DEFAULT_PARTITION__"


LOADS = "_loads"


def last_load(spark: SparkSession, root: str) -> int | None:
    """The highest number that a load of this store has claimed or written under."""
    claims = [int(path.rpartition("/")[2]) for path in found(spark, f"{root}/{LOADS}/*")]
    numbers = claims + [value_in(path, "load") for path in found(spark, f"{root}/*/load=*")]
    return max(numbers, default=None)


def claim_load(spark: SparkSession, root: str, token: str) -> int:
    """The number of the load that goes by this token: found again, or the next one that nobody has.

    A number is claimed by creating its file, which only one of several jobs can do.
    """
    for path in found(spark, f"{root}/{LOADS}/*"):
        if text_of(spark, path) == token:
            return int(path.rpartition("/")[2])
    last = last_load(spark, root)
    number = 0 if last is None else last + 1
    while not create_once(spark, f"{root}/{LOADS}/{number}", token):
        number += 1
    return number
