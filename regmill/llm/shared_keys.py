"""Keys that two owners or more hold, with their owners, without a row per key.

A batch of (key, owner) entries is sorted by key. The first owner of each key goes to the key's bucket,
packed with the other firsts of the bucket into one row of arrays; further owners of a key in
the batch are shared for certain and pass at once. So a bucket gets one entry per key and batch, however
frequent the key, and finds what other batches share. Keys are cut to the bucket's number
and 32 bits; two keys that agree in those are taken for one, which can only add entries.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

PACKED = "bucket int, keys binary, owners binary, extras binary, known binary"
SPREAD = 1 << 16  # entries of a row that passes


def buckets_of(size: int, each: int) -> int:
    """Buckets for an input of `size` bytes or entries, one for `each`, however many partitions Spark makes of it."""
    return max(1, -(-size // each))


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of numbers, compressed: small numbers leave their high planes empty."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def squeeze_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned keys by their distances."""
    return _planes(np.diff(keys, prepend=keys.dtype.type(0)))


def squeeze_owners(owners: np.ndarray) -> bytes:
    """The different owners, then for each entry its place among them."""
    table, places = np.unique(owners, return_inverse=True)
    head = _planes(table.astype("<i8"))
    return len(head).to_bytes(4, "little") + head + _planes(places.astype("<u4"))


def open_keys(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(_from_planes(data, kind), dtype=kind)


def open_owners(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:4], "little")
    return _from_planes(data[4 : 4 + size], "<i8")[_from_planes(data[4 + size :], "<u4")]


def cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Key as bucket and the next 32 bits, in the order of the keys."""
    high, low = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
    scaled = high * np.uint64(buckets)
    return ((scaled >> np.uint64(32)) << np.uint64(32)) | (
        (scaled + (low * np.uint64(buckets) >> np.uint64(32))) & np.uint64(0xFFFFFFFF)
    )


def pack(
    keys: np.ndarray, owners: np.ndarray, extras: np.ndarray | None, buckets: int, squeeze: bool = False
) -> Iterator[pa.RecordBatch]:
    """Rows for the entries of one batch; keys are uniform unsigned 64-bit numbers, extras may be left out.

    With `squeeze`, keys and owners of a row are compressed.
    """
    keys = cut(keys, buckets)
    order = np.lexsort((owners, keys))
    extras = np.empty(len(keys), "V0") if extras is None else extras
    keys, owners, extras = keys[order], owners[order], extras[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners, extras = keys[fresh], owners[fresh], extras[fresh]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    many = np.zeros(len(keys), bool)
    many[:-1] = ~first[1:]
    rows = []

    def row(bucket: int, k, o, e, known) -> None:
        if squeeze:
            rows.append((bucket, squeeze_keys(k), squeeze_owners(o), e.tobytes(), np.packbits(known).tobytes()))
        else:
            rows.append((bucket, k.tobytes(), o.tobytes(), e.tobytes(), known.tobytes()))

    k, o, e, known = keys[first], owners[first], extras[first], many[first]
    edges = np.searchsorted(k >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    small = (k & np.uint64(0xFFFFFFFF)).astype("<u4")
    for bucket in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        a, b = edges[bucket], edges[bucket + 1]
        row(bucket, small[a:b], o[a:b], e[a:b], known[a:b])
    k, o, e = keys[~first], owners[~first], extras[~first]
    for a in range(0, len(k), SPREAD):
        run = k[a : a + SPREAD], o[a : a + SPREAD], e[a : a + SPREAD]
        # these need no group: keys and owners make the bucket, as batches that share keys differ in owners
        spread = zlib.crc32(run[1].tobytes(), zlib.crc32(run[0].tobytes()))
        row(-1 - (spread & 0x7FFFFFFF), *run, np.empty(0, bool))
    schema = pa.schema(
        [("bucket", pa.int32())] + [(n, pa.binary()) for n in ("keys", "owners", "extras", "known")]
    )
    for a in range(0, len(rows), 1024):
        part = list(zip(*rows[a : a + 1024], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, schema, strict=True)], schema=schema)


def shared(packed: DataFrame, squeezed: bool = False) -> DataFrame:
    """key, owner, extra of every entry whose key another owner holds too; `squeezed` as the rows were packed."""

    def find(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        sizes = []
        if squeezed:
            parts = [open_keys(x, "<u8" if bucket < 0 else "<u4") for x in table.column("keys").to_pylist()]
            sizes = [len(p) for p in parts]
            keys = np.concatenate(parts).tobytes()
            owners = np.concatenate([open_owners(x) for x in table.column("owners").to_pylist()])
        else:
            owners = np.frombuffer(b"".join(table.column("owners").to_pylist()), "<i8")
            keys = b"".join(table.column("keys").to_pylist())
        extras = np.frombuffer(b"".join(table.column("extras").to_pylist()), "<i8")
        extras = extras if len(extras) else np.zeros(len(owners), "<i8")
        if bucket < 0:
            keys = np.frombuffer(keys, "<u8")
        else:
            known = table.column("known").to_pylist()
            if squeezed:
                bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(known, sizes, strict=True)]
                known = np.concatenate(bits).astype(bool)
            else:
                known = np.frombuffer(b"".join(known), bool)
            keys = np.frombuffer(keys, "<u4").astype(np.uint64) | np.uint64(bucket << 32)
            order = np.lexsort((owners, keys))
            keys, owners, extras, known = keys[order], owners[order], extras[order], known[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            # entries of a key that differ in owner, or that a batch knew to be shared
            low, high = np.minimum.reduceat(owners, starts), np.maximum.reduceat(owners, starts)
            wanted = (low != high) | np.logical_or.reduceat(known, starts)
            keep = np.repeat(wanted, np.diff(np.append(starts, len(keys))))
            fresh = np.ones(len(keys), bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
            keep &= fresh
            keys, owners, extras = keys[keep], owners[keep], extras[keep]
        return pa.table({"key": keys.astype("<i8"), "owner": owners, "extra": extras})

    return packed.groupBy("bucket").applyInArrow(find, "key bigint, owner bigint, extra bigint")
