"""Registry of the checked queries: a Spark callable and, where SQL can say it, the equal SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regmill.functions.identity import key_pads
from regmill.rules import NAMED_ENTITIES

# Buckets of stored pages, and the least number of partitions that rows are dealt out over.
CORES = 8
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Key of the checked queries only; real loads pass their own.
DEMO_KEY = "0123456789abcdef00112233445566778899aabbccddeeff0123456789abcdef"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def shares(spark: SparkSession) -> int:
    """Partitions over which queries deal out the rows of files with few splits before they build markup of them."""
    return max(CORES, 2 * spark.sparkContext.defaultParallelism)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- SQL fragments for the oracle side ---------------------------------------


def sql_content(html: str = "html") -> str:
    return rf"regexp_replace({html}, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g')"


def sql_decode(x: str) -> str:
    for name, char in NAMED_ENTITIES:
        char = char.replace("'", "''")
        x = f"replace({x}, '&{name};', '{char}')"
    return x


def sql_plain(x: str) -> str:
    return sql_decode(f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')")


SPACE_CLASS = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g')"


def sql_paragraphs(html: str) -> str:
    closed = rf"regexp_replace({html}, '(?i)</(article|div|section|main|td|li|body|html)\s*>', '</p></\1>', 'g')"
    opened = rf"regexp_replace({closed}, '(?i)<p(\s[^>]*)?>', '</p><p>', 'g')"
    return f"regexp_extract_all({opened} || '</p>', '(?s)<p>(.*?)</p>', 1)"


def sql_keyed_id(message: str) -> str:
    inner, outer = key_pads(DEMO_KEY)
    return f"upper(sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message})))))"
