"""Keyed content ids, computed inside the JVM."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64


def key_pads(key_hex: str) -> tuple[str, str]:
    """Inner and outer HMAC-SHA256 pads (hex) of a key."""
    key = bytes.fromhex(key_hex)
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def keyed_id(message: Column, key_hex: str) -> Column:
    """Upper-case HMAC-SHA256 of a text; null in, null out."""
    inner_pad, outer_pad = key_pads(key_hex)
    inner = F.sha2(F.concat(F.unhex(F.lit(inner_pad)), F.encode(message, "UTF-8")), 256)
    return F.upper(F.sha2(F.concat(F.unhex(F.lit(outer_pad)), F.unhex(inner)), 256))
