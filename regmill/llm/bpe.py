"""Byte-level BPE, encoding and decoding, with a rank queue on a hierarchical bitmap.

A piece (a match of the split pattern) is a linked list of byte strings. Every mergeable pair waits in
the bucket of its rank; a bitmap of three levels of 64-bit words marks the buckets in use, and finding the
first set bit on each level gives the lowest rank. Entries whose pair has changed since are stale and
skipped when they come up. The new pieces of many texts share a queue, so a bucket is found once for all their
pairs; a very long piece is one list like any other.

Texts are encoded where they are, without a shuffle. A null text is empty and has no ids; a text is never
cut; repeated rows get equal results and an empty table an empty one. Other columns, named anyhow, are kept by
`encode` but for one named like its result, which is replaced.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.llm.chunks import ChunkEncoder, Memo, kept
from regmill.llm.hashing import blocks
from regmill.llm.registry import documents, query

SINGLE = [bytes([x]) for x in range(256)]
MEMO_ENTRIES = 400_000  # in each of two generations of chunks and of pieces: at most 400 MB together
ROWS = 1024  # rows of an Arrow batch that are in work at once
QUEUED = 1 << 18  # bytes that share a queue, one piece at least


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank per line. Its size is the vocabulary's."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Positions by rank, lowest rank first.

    One bit stands for a bucket in use, in words of 64; a bit of the next level for a word that is not zero.
    Who finds a bucket in `buckets` may append to it; `push` opens one.
    """

    __slots__ = ("buckets", "low", "middle", "top")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.low: dict[int, int] = {}  # 64 ranks a word
        self.middle: dict[int, int] = {}  # 64 low words a word
        self.top = 0  # one bit for each middle word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        a, b = rank >> 6, rank >> 12
        self.low[a] = self.low.get(a, 0) | 1 << (rank & 63)
        self.middle[b] = self.middle.get(b, 0) | 1 << (a & 63)
        self.top |= 1 << b

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions in order; the bucket is closed."""
        top = self.top
        if not top:
            return None
        b = (top & -top).bit_length() - 1
        word = self.middle[b]
        a = (b << 6) + (word & -word).bit_length() - 1
        word = self.low[a]
        first = word & -word
        rank = (a << 6) + first.bit_length() - 1
        word = self.low[a] = word ^ first
        if not word:
            word = self.middle[b] = self.middle[b] ^ 1 << (a & 63)
            if not word:
                self.top = top ^ 1 << b
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


def encode_pieces(pieces: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Ids of each piece: always its pair of lowest rank is merged, the first of equals.

    The pieces lie in one linked list, parted by None, and share a queue: pieces do not touch each other, so
    a bucket may be worked off for all of them together.
    """
    rank_of = ranks.get
    parts: list[bytes | None] = []
    wanted: list[int] = []
    starts = []
    for piece in pieces:
        starts.append(len(parts))
        parts += [SINGLE[x] for x in piece]
        parts.append(None)
        wanted += [rank_of(piece[i : i + 2], -1) for i in range(len(piece) - 1)]
        wanted += (-1, -1) if piece else (-1,)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = RankQueue()
    push, pop, opened = queue.push, queue.pop, queue.buckets.get
    for i, rank in enumerate(wanted):
        if rank >= 0:
            push(rank, i)
    while (found := pop()) is not None:
        rank, bucket = found
        least = rank + 1
        for at, i in enumerate(bucket):
            if wanted[i] != rank:
                continue  # stale: the pair here has changed
            j = after[i]
            merged = parts[i] = parts[i] + parts[j]
            wanted[j] = -1
            k = after[i] = after[j]
            before[k] = i
            follower = parts[k]
            if follower is None:
                wanted[i] = -1
            else:
                new = wanted[i] = rank_of(merged + follower, -1)
                if new >= 0:
                    if (other := opened(new)) is None:
                        push(new, i)
                    else:
                        other.append(i)
                    if new < least:
                        least = new
            h = before[i]
            leader = parts[h]
            if leader is not None:
                new = wanted[h] = rank_of(leader + merged, -1)
                if new >= 0:
                    if (other := opened(new)) is None:
                        push(new, h)
                    else:
                        other.append(h)
                    if new < least:
                        least = new
            if least <= rank:  # the merge made a pair that comes before the rest of the bucket
                for i in bucket[at + 1 :]:
                    push(rank, i)
                break
    out = []
    for i in starts:
        ids = []
        while (part := parts[i]) is not None:
            ids.append(ranks[part])
            i = after[i]
        out.append(ids)
    return out


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    return encode_pieces([piece], ranks)[0]


class Codec:
    """Encoder and decoder of one vocabulary; holds bounded memos of chunks and pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        # White_Space is what the pattern's \s means to the reference library
        split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.ranks, self.findall = ranks, split.findall
        self.pieces = Memo(lambda piece: self._packed([piece])[0], MEMO_ENTRIES)
        self.chunks = ChunkEncoder(
            lambda text: b"".join(map(self.pieces.__getitem__, self.findall(text))), MEMO_ENTRIES, self._many
        )

    def _packed(self, pieces: list[str]) -> list[bytes]:
        """Ids of the pieces; those that are no token go through the queue together, a bounded number of bytes a time."""
        raw = [piece.encode() for piece in pieces]
        whole = [self.ranks.get(piece) for piece in raw]
        split = [piece for piece, rank in zip(raw, whole, strict=True) if rank is None]
        made = (x for a, b in blocks([len(p) for p in split], QUEUED) for x in encode_pieces(split[a:b], self.ranks))
        ids = ([rank] if rank is not None else next(made) for rank in whole)
        return [struct.pack(f"<{len(x)}I", *x) for x in ids]

    def _many(self, texts: list[str]) -> list[bytes]:
        cut = [self.findall(text) for text in texts]
        new = self.pieces.unknown({piece for pieces in cut for piece in pieces})
        for piece, ids in zip(new, self._packed(new), strict=True):
            self.pieces.put(piece, ids)
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cut]

    def encode(self, text: str | None) -> bytes:
        return self.chunks.ids(text)

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        for a, b in blocks([len(t or "") for t in texts]):
            yield from self.chunks.many(texts[a:b])

    def forget(self) -> None:
        self.pieces.drop()
        self.chunks.drop()

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


def _codec(df: DataFrame, path: str, pattern: str, remember: bool = False):
    """Context that lends a task its worker's codec. The vocabulary is read once on the driver and broadcast: its size
    does not depend on the data. Memos go with the task, so that whatever the worker does next has its memory, unless
    it is to `remember` them for the next task."""
    with open(path, "rb") as file:
        name = f"codec {hashlib.sha256(file.read()).hexdigest()} {pattern}"
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    @contextmanager
    def worker() -> Iterator[Codec]:
        codec = kept(name, lambda: Codec(ranks.value, pattern))
        try:
            yield codec
        finally:
            if not remember:
                codec.forget()

    return worker


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and `ids`: the text's ids as little-endian unsigned 32-bit integers."""
    worker = _codec(docs, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker() as codec:
            for batch in _slices(batches):
                made = pa.array(list(codec.encode_all(batch.column(text).to_pylist())), pa.binary())
                keep = [n for n in batch.schema.names if n != ids]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [made], keep + [ids])

    schema = docs.drop(ids).withColumn(ids, F.lit(b"").cast("binary")).schema
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and `decoded`: the bytes that the ids stand for."""
    worker = _codec(encoded, path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker() as codec:
            for batch in _slices(batches):
                made = pa.array([codec.decode(x) for x in batch.column(ids).to_pylist()], pa.binary())
                keep = [n for n in batch.schema.names if n != decoded]
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in keep] + [made], keep + [decoded])

    schema = encoded.drop(decoded).withColumn(decoded, F.lit(b"").cast("binary")).schema
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_tokens and the digests of ids and decoded bytes: encode and decode in one pass, ids stay in the task."""
    worker = _codec(docs, path, pattern, remember=True)
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with worker() as codec:
            for batch in batches:
                counts, of_ids, of_text = [], [], []
                for made in codec.encode_all(batch.column(1).to_pylist()):
                    counts.append(len(made) // 4)
                    of_ids.append(hashlib.sha256(made).hexdigest())
                    of_text.append(hashlib.sha256(codec.decode(made)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


@query("op4_byte_bpe")
def op4(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
