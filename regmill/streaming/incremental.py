"""Incremental load: new input files become one appended batch each, in the index the full load fills."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from regmill.operators import folders
from regmill.operators.store import append_batch


def load_number(spark: SparkSession, root: str, checkpoint: str) -> int:
    """The load that belongs to a checkpoint: claimed on its first run, found again on every later one.

    Streams that start together get different numbers. A checkpoint that was removed and starts over is a new load.
    """
    checkpoint, runs = checkpoint.rstrip("/"), 0
    held = {folders.text_of(spark, path) for path in folders.found(spark, f"{root}/{folders.LOADS}/*")}
    while f"stream {runs} {checkpoint}" in held:
        runs += 1
    if runs and folders.exists(spark, checkpoint):
        runs -= 1
    return folders.claim_load(spark, root, f"stream {runs} {checkpoint}")


def run_batches(
    stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Hand what is new to `load`, batch by batch, and stop."""
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_incremental(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
    source: str = "main",
) -> StreamingQuery:
    """Process what is new and stop.

    The checkpoint remembers which files were taken. A micro-batch that is replayed after a
    lost driver or executor overwrites its own folder, so no write is counted twice. Earlier loads,
    other sources and other checkpoints have folders of their own.
    """
    number = load_number(stream.sparkSession, root, checkpoint)
    return run_batches(
        stream, checkpoint, lambda batch, batch_id: append_batch(build(batch), root, batch_id, number, source)
    )
