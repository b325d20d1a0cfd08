"""From raw documents to token ids: each stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmill.llm import bpe, exact_dedup, mixing, ngram_join, quality_rules
from regmill.session import Scratch, scratch, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_before: dict[str, Scratch] = {}


def _stage(function: Stage) -> Stage:
    """A stage that drops the tables the stage before it needed: what it gets was written and read again, so nothing
    reads those any more. Its own stay until its result has been written."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        if app in _before:
            _before.pop(app).drop()
        with scratch(spark) as _before[app]:
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and are more likely good than not."""
    return quality_rules.keep_good(docs)


@_stage
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of largest id."""
    return exact_dedup.exact_dedup(docs)


@_stage
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard similarity of 0.8 or more over five-word shingles, the least id."""
    return ngram_join.keep_one(docs, width=5, percent=80)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in training order, repeated or left out as their source's target asks."""
    return mixing.mix(docs)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, n_tokens, ids (little-endian unsigned 32-bit) and, after decoding the
    ids again, whether the text came back."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path, pattern), path, pattern)
    return decoded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("decoded_equal"),
    )


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", tokens),
]

# Byte-level BPE has no SQL form; the stages are tested against plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each result written as a table and read again for the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"stage-{number + 1}")
    return docs
