"""Suffix-array dedup: bytes covered by a string of `length` bytes that also starts in a document of smaller id.

Sorting all suffixes of a corpus together does not distribute. So the windows of `length` bytes are first dealt
out by content: the anchor of a window is its GRAM-byte string of least hash, leftmost of equals. Equal
windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so one window in
about fourteen brings a new anchor.

 1. every row's anchors go, packed by batch, to the buckets of their hash, which return those that another row
    holds too (`shared_keys`; a frequent anchor comes once a batch). Buckets follow the bytes of the texts, not the
    partitions, so a batch packs as many rows however many tasks there are;
 2. rows with such anchors cut out, for each, its context: the bytes of all its windows. Equal contexts within a
    batch are settled at once: only the one of least id goes on, so a passage that a third of all
    documents hold is sent once a batch;
 3. the contexts of a bucket are suffix-sorted to `length` bytes by deep-shallow sorting (`suffix_sort`), which
    yields the equal windows and for each the least id among them;
 4. the runs found are merged per row and its text is cut.

Rows are judged on the input, not on what is left. A null text is empty. Null ids are larger than all others;
rows of equal ids do not remove from each other. Equal rows give equal results. A text shorter than `length` keeps
everything, an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.llm import shared_keys
from regmill.llm.hashing import blocks, mix
from regmill.llm.registry import documents, query
from regmill.llm.suffix_sort import SYMBOL, equal_windows

GRAM = 24
BUCKET_BYTES = 16_000_000  # of texts whose anchors share a bucket
FINER = 3  # a bucket's contexts go to 2^FINER buckets, as they hold more than its anchors
NO_ID = np.iinfo(np.int64).max


def anchors(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """hash, text number, place of the anchor, first window and number of windows, of every anchor of the block.

    Places count from the start of the text. Hash and place share a number, so the least number is the leftmost
    least hash; 32 bits of hash order the strings and ties go to the left, alike wherever the window stands.
    """
    span = length - GRAM + 1  # strings in a window
    buffer = b"".join(texts)
    n = len(buffer) - GRAM + 1
    none = np.empty(0, np.int64)
    if n < span:
        return none.view(np.uint64), none, none, none, none
    hashes = np.full(n, GRAM, np.uint64)
    for at in range(0, GRAM, 8):
        part = np.ndarray((n,), "<u8", buffer, offset=at, strides=(1,))
        hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + part)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[: len(least)]
    place = np.arange(len(least))
    valid = place + length <= ends[owner]
    place, owner = place[valid], owner[valid]
    at = (least[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    begin = starts[owner[first]]
    return mix(hashes[at[first]]), owner[first], at[first] - begin, place[first] - begin, counts


def _anchor_rows(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            texts = _texts(batch, 1)
            keys, owners = [], []
            for a, b in blocks([len(t) for t in texts]):
                found, owner, *_ = anchors(texts[a:b], length)
                keys.append(found)
                owners.append(rows[a:b][owner])
            if keys:
                yield from shared_keys.pack(np.concatenate(keys), np.concatenate(owners), None, buckets, squeeze=True)

    return docs.select("row", "text").mapInArrow(run, shared_keys.PACKED)


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


# A row holds the contexts of one bucket and batch: their numbers, then their bytes one after the other, compressed.
CONTEXTS = "bucket int, n int, packed binary"
_NUMBERS = (("keys", "<u4"), ("rows", "<i8"), ("ids", "<i8"), ("begins", "<i4"), ("sizes", "<i4"))


def _pack(columns: list[np.ndarray | list], texts: list[bytes], squeeze: zstandard.ZstdCompressor) -> bytes:
    numbers = [np.asarray(c, kind).tobytes() for c, (_, kind) in zip(columns, _NUMBERS, strict=True)]
    return squeeze.compress(b"".join(numbers + texts))


def _unpack(counts: list[int], packed: list[bytes]) -> tuple[dict[str, np.ndarray], bytes]:
    """The numbers of all rows by name, and all their bytes."""
    open_, parts, texts = zstandard.ZstdDecompressor(), {name: [] for name, _ in _NUMBERS}, []
    for n, frame in zip(counts, packed, strict=True):
        data, at = open_.decompress(frame), 0
        for name, kind in _NUMBERS:
            parts[name].append(np.frombuffer(data, kind, n, at))
            at += parts[name][-1].nbytes
        texts.append(data[at:])
    return {name: np.concatenate(p) for name, p in parts.items()}, b"".join(texts)


def _contexts(held: DataFrame, length: int, buckets: int) -> DataFrame:
    """Contexts of the shared anchors of each row (row, id, text, keys), and runs settled within a batch.

    Settled runs have sizes but no bytes and are spread over negative buckets.
    """

    def packed(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        """found: (key, row, id, begin, size, bytes); keys below 2^32 are no anchors' but spread settled runs."""
        found.sort(key=lambda x: x[0])
        numbers = np.array([x[0] for x in found], np.uint64)
        cuts = np.flatnonzero(np.diff(numbers >> np.uint64(32))) + 1
        squeeze, out = zstandard.ZstdCompressor(level=3), []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(found)], strict=True):
            keys, rows, ids, begins, sizes, texts = zip(*found[a:b], strict=True)
            small = numbers[a:b] & np.uint64(0xFFFFFFFF)
            out.append(((keys[0] >> 32) - 1, b - a, _pack([small, rows, ids, begins, sizes], list(texts), squeeze)))
        types = (pa.int32(), pa.int32(), pa.binary())
        for x in range(0, len(out), 256):
            columns = zip(*out[x : x + 256], strict=True)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "n", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_pylist()
            ids = batch.column(1).fill_null(NO_ID).to_pylist()
            texts = _texts(batch, 2)
            wanted = batch.column(3)
            owner_of = np.repeat(np.arange(len(rows)), np.diff(wanted.offsets.to_numpy()))
            pairs = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            order = np.lexsort((pairs, owner_of))
            pairs, owner_of = pairs[order], owner_of[order]
            limits = np.searchsorted(owner_of, np.arange(len(rows) + 1))
            best: dict[tuple[int, bytes], tuple] = {}
            out, settled = [], []
            for a, b in blocks([len(t) for t in texts]):
                found, owner, _, begin, count = anchors(texts[a:b], length)
                keys = shared_keys.cut(found, buckets)
                keep = np.zeros(len(keys), bool)
                edges = np.searchsorted(owner, np.arange(b - a + 1))
                for k in range(b - a):
                    mine = pairs[limits[a + k] : limits[a + k + 1]]
                    x, y = edges[k], edges[k + 1]
                    if len(mine) and x < y:
                        here = np.minimum(np.searchsorted(mine, keys[x:y]), len(mine) - 1)
                        keep[x:y] = mine[here] == keys[x:y]
                chosen = np.flatnonzero(keep)
                for key, k, p, c in zip(
                    keys[chosen].tolist(), owner[chosen].tolist(), begin[chosen].tolist(), count[chosen].tolist(), strict=True
                ):
                    context = texts[a + k][p : p + c + length - 1]
                    here = (ids[a + k], rows[a + k], p)
                    other = best.get((key, context))
                    if other is None or here[0] < other[0]:
                        best[(key, context)] = here
                        here, other = other, here
                    if here is None:
                        continue
                    if other[0] < here[0]:
                        settled.append((0, here[1], here[0], here[2], len(context), b""))
                    else:  # equal ids do not remove from each other, but others may remove from both
                        out.append(((key << FINER) + (1 << 32), here[1], here[0], here[2], len(context), context))
            out += [
                ((key << FINER) + (1 << 32), row, id, p, len(context), context) for (key, context), (id, row, p) in best.items()
            ]
            if out:
                yield from packed(out)
            for x in range(0, len(settled), shared_keys.SPREAD):
                for part in packed(settled[x : x + shared_keys.SPREAD]):
                    spread = pa.array([-1 - settled[x][1] % (1 << 20)] * len(part), pa.int32())
                    yield part.set_column(0, "bucket", spread)

    return held.mapInArrow(run, CONTEXTS)


def _runs(contexts: DataFrame, length: int) -> DataFrame:
    """row, begin, end of the runs of removed bytes."""

    def run(table: pa.Table) -> pa.Table:
        numbers, joined = _unpack(table.column("n").to_pylist(), table.column("packed").to_pylist())
        rows, ids, first = numbers["rows"], numbers["ids"], numbers["begins"]
        sizes = numbers["sizes"].astype(np.int64)
        if table.column("bucket")[0].as_py() < 0:
            return pa.table({"row": rows, "begin": first, "end": first + numbers["sizes"]})
        buffer = joined + b"\0" * SYMBOL
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(sizes)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = (np.cumsum(sizes) - sizes)[owner] + inside
        # windows of one anchor can be equal only if the anchor is the same
        window, segment = equal_windows(buffer, starts, numbers["keys"].astype(np.int64)[owner], length)
        if len(window):
            cuts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            least = np.minimum.reduceat(ids[owner[window]], cuts)
            least = np.repeat(least, np.diff(np.append(cuts, len(window))))
            window = np.sort(window[least < ids[owner[window]]])
        if not len(window):
            none = np.empty(0, np.int32)
            return pa.table({"row": none.astype(np.int64), "begin": none, "end": none})
        apart = np.flatnonzero((np.diff(window) > 1) | (np.diff(owner[window]) != 0)) + 1
        a, b = window[np.concatenate([[0], apart])], window[np.concatenate([apart - 1, [len(window) - 1]])]
        begin = first[owner[a]] + inside[a]
        end = first[owner[b]] + inside[b] + length
        return pa.table({"row": rows[owner[a]], "begin": begin.astype(np.int32), "end": end.astype(np.int32)})

    return contexts.groupBy("bucket").applyInArrow(run, "row bigint, begin int, end int")


def repeated_runs(docs: DataFrame, length: int) -> DataFrame:
    """row and spans (maximal runs of removed bytes, in order) of the rows (row, id, text) that lose bytes."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = shared_keys.buckets_of(size, BUCKET_BYTES)
    shared = shared_keys.shared(_anchor_rows(docs, length, buckets), squeezed=True)
    keys = shared.groupBy(F.col("owner").alias("row")).agg(F.collect_list("key").alias("keys"))
    held = docs.join(keys, "row").select("row", "id", "text", "keys")
    found = _runs(_contexts(held, length, buckets), length)
    return found.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("runs"))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = 50) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, spans (begin, end) and kept (the remaining bytes) of every row."""
    id_type = docs.schema[id].dataType.simpleString()
    rows = docs.select(
        F.xxhash64(F.col(id), F.col(text)).alias("row"), F.col(id).alias("id"), F.col(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = _texts(batch, 1), batch.column(2).to_pylist()
            sizes, removed, spans, kept = [], [], [], []
            for value, found in zip(texts, runs, strict=True):
                merged: list[list[int]] = []
                for r in found or []:
                    if merged and r["begin"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r["end"])
                    else:
                        merged.append([r["begin"], r["end"]])
                sizes.append(len(value))
                removed.append(sum(b - a for a, b in merged))
                spans.append([{"begin": a, "end": b} for a, b in merged])
                edges = [0, *(x for pair in merged for x in pair), len(value)]
                kept.append(b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            pair = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(spans, pa.list_(pair)),
                    pa.array(kept, pa.binary()),
                ],
                ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
            )

    found = rows.join(repeated_runs(rows, length), "row", "left").select("id", "text", "runs")
    schema = f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary"
    return found.mapInArrow(run, schema).withColumnRenamed("id", id)


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
