"""Bloom filters as tables of bitmaps: keys that are surely absent from a large table are told without moving it.

A filter is a table (block, bits). A key belongs to one block of 32,768 bits and sets four of them, so a filter is built
by one aggregate that is combined before its shuffle, and one look-up row decides about a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
BITS_PER_KEY = 16
PROBES = 4
MAX_BYTES = 64 << 20


def block_count(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    return max(1, -(-keys * bits_per_key // BLOCK_BITS))


def filter_bytes(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """What a filter of so many keys takes, and so what a look-up sends to each executor."""
    return block_count(keys, bits_per_key) * BLOCK_BITS // 8


def _block(key: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(blocks))


def _positions(key: list[str]) -> list[Column]:
    """Four places in a block, 15 bits of a second hash each."""
    second = F.xxhash64(*key, F.lit("bloom"))
    return [F.shiftrightunsigned(second, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]


def build(rows: DataFrame, key: list[str], blocks: int) -> DataFrame:
    """The filter of the rows' keys; nulls in a key are values like any other."""
    places = rows.select(_block(key, blocks).alias("block"), F.explode(F.array(*_positions(key))).alias("at"))
    return places.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))


def _is_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1


def look_up(rows: DataFrame, key: list[str], bloom: DataFrame, blocks: int, into: str = "maybe") -> DataFrame:
    """Rows with whether their key may be in the filter; false is certain.

    The filter is broadcast: its size follows from `blocks`, which callers bound by `filter_bytes`.
    """
    asked = rows.withColumn("_block", _block(key, blocks))
    named = F.broadcast(bloom.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    hit = F.lit(True)
    for at in _positions(key):
        hit = hit & _is_set(F.col("_bits"), at)
    found = asked.join(named, "_block", "left").withColumn(into, F.coalesce(hit, F.lit(False)))
    return found.select(*rows.columns, into)
