"""Token-id files of byte planes.

The documents are range-partitioned and sorted by id, encoded, and each ends with the end id. A task writes
segments of whole documents; a segment holds fixed-size blocks of ids. A block is transposed into four byte planes
(the first bytes of all its ids, then the second ones, ...), each compressed with zstandard. Layout of a
segment, all numbers little-endian:

    8 bytes   magic "BPLANES1"
    planes    zstandard frames, block by block, four a block
    index     for each block: unsigned 32-bit number of ids, then offset and length (64-bit) of its four planes
    documents number of ids of each document (64-bit)
    footer    64-bit offset of the index, number of blocks, of documents

Spark writes the segments, one binary value each with its place (part, segment), as uncompressed
Parquet: commits and lost executors are its business. Reading decodes segments independently.

The library reads the file's added tokens in a text, so <|endoftext|> there is its one id. They hold no
space, so texts may still be cut at spaces. A null text is empty and holds the end id alone. Null ids come first; rows of equal id follow by the text's
hash. Repeated rows are written each. An empty table gives files without segments. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regmill.llm.chunks import ChunkEncoder, kept
from regmill.llm.hashing import blocks
from regmill.llm.registry import documents, query
from regmill.session import fresh_dir

MAGIC = b"BPLANES1"
BLOCK_IDS = 65_536
SEGMENT_IDS = 2_000_000
JOINED = 256  # new chunks that the library gets as one text
MEMO_ENTRIES = 1_000_000  # chunks in each of the two generations of a worker's memo, some 0.2 KB each
_ENTRY = np.dtype([("ids", "<u4"), ("plane", [("at", "<u8"), ("size", "<u8")], 4)])


def pack(ids: np.ndarray, lengths: list[int], block_ids: int = BLOCK_IDS) -> bytes:
    """The segment of these ids, cut into documents by `lengths`."""
    squeeze = zstandard.ZstdCompressor(level=3)
    out, at, index = [MAGIC], len(MAGIC), []
    for first in range(0, len(ids), block_ids):
        block = np.ascontiguousarray(ids[first : first + block_ids], "<u4")
        planes = np.ascontiguousarray(block.view("u1").reshape(-1, 4).T)
        places = []
        for plane in planes:
            frame = squeeze.compress(plane.tobytes())
            places.append((at, len(frame)))
            out.append(frame)
            at += len(frame)
        index.append((len(block), places))
    out.append(np.array(index, _ENTRY).tobytes())
    out.append(np.array(lengths, "<u8").tobytes())
    out.append(np.array([at, len(index), len(lengths)], "<u8").tobytes())
    return b"".join(out)


def _parts(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    if segment[: len(MAGIC)] != MAGIC:
        raise ValueError("not a segment of byte planes")
    at, n_blocks, n_docs = (int(x) for x in np.frombuffer(segment[-24:], "<u8"))
    index = np.frombuffer(segment, _ENTRY, n_blocks, at)
    return index, np.frombuffer(segment, "<u8", n_docs, at + index.nbytes)


def unpack_block(segment: bytes, number: int) -> np.ndarray:
    """The ids of one block, found by the index."""
    entry = _parts(segment)[0][number]
    open_ = zstandard.ZstdDecompressor()
    planes = np.empty((4, int(entry["ids"])), "u1")
    for row, place in zip(planes, entry["plane"], strict=True):
        at, size = int(place["at"]), int(place["size"])
        row[:] = np.frombuffer(open_.decompress(segment[at : at + size]), "u1")
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def unpack(segment: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the number of ids of each document."""
    index, lengths = _parts(segment)
    blocks = [unpack_block(segment, k) for k in range(len(index))]
    return (np.concatenate(blocks) if blocks else np.empty(0, "<u4")), lengths


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    block_ids: int = BLOCK_IDS,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Write the files below `path`: part, segment, n_ids, ids of the documents, content."""
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    digest, model = hashlib.sha256(content.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(content)
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        def make() -> ChunkEncoder:
            library = Tokenizer.from_str(model.value)

            def encode(piece: str) -> bytes:
                return np.array(library.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()

            # \u0120 stands for the space in byte-level vocabularies: a chunk has one space, at its start
            spaced = np.zeros(library.get_vocab_size(), bool)
            spaced[[i for token, i in library.get_vocab().items() if token[0] == "\u0120"]] = True

            def encode_many(pieces: list[str]) -> list[bytes]:
                out = []
                joined = ["".join(pieces[a : a + JOINED]) for a in range(0, len(pieces), JOINED)]
                for found in library.encode_batch_fast(joined, add_special_tokens=False):
                    ids = np.array(found.ids, "<u4")
                    edges = [*(4 * np.flatnonzero(spaced[ids])).tolist(), 4 * len(ids)]
                    raw = ids.tobytes()
                    out += [raw[a:b] for a, b in pairwise(edges)]
                return out

            return ChunkEncoder(encode, MEMO_ENTRIES, encode_many)

        encoder, end = kept(f"library {digest}", make), np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        made, lengths, names, size, number = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            content = pack(np.frombuffer(b"".join(made), "<u4"), lengths, block_ids)
            columns = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([size], pa.int64()),
                pa.array([names], pa.list_(names_type)),
                pa.array([content], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["part", "segment", "n_ids", "docs", "content"])

        for batch in batches:
            names_type = batch.column(0).type
            texts = batch.column(1).to_pylist()
            encoded = (x for a, b in blocks([len(t or "") for t in texts]) for x in encoder.many(texts[a:b]))
            for name, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids += end
                made.append(ids)
                names.append(name)
                lengths.append(len(ids) // 4)
                size += len(ids) // 4
                if size >= segment_ids:
                    yield segment()
                    made, lengths, names, size, number = [], [], [], 0, number + 1
        if names:
            yield segment()

    ordered = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", F.xxhash64("text"))
    )
    rows = ordered.mapInArrow(run, f"part int, segment int, n_ids bigint, docs array<{id_type}>, content binary")
    rows.write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before), n_tokens and ids of every document of the files."""
    files = spark.read.parquet(path)
    id_type = files.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, names, content in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                ids, lengths = unpack(content)
                ends = np.cumsum(lengths.astype("i8"))
                starts = ends - lengths.astype("i8")
                values = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()),
                        pa.array([number] * n, pa.int32()),
                        pa.array(names, batch.schema.field("docs").type.value_type),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths.astype("i8"), pa.int64()),
                        pa.array(values, pa.binary()),
                    ],
                    ["part", "segment", "id", "inside", "n_tokens", "ids"],
                )

    opened = files.select("part", "segment", "docs", "content").mapInArrow(
        run, f"part int, segment int, id {id_type}, inside bigint, n_tokens bigint, ids binary"
    )
    return _placed(files, opened).select(F.col("id").alias(id), "start", "n_tokens", "ids")


def _placed(files: DataFrame, opened: DataFrame) -> DataFrame:
    """With `start`: offsets of parts, then of segments within a part, then within the segment."""
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("size"))
    rising = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("size").over(rising), F.lit(0)).alias("part_at"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.withColumn("segment_at", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
    return opened.join(places.drop("n_ids"), ["part", "segment"]).withColumn(
        "start", F.col("part_at") + F.col("segment_at") + F.col("inside")
    )


def read_digests(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """As `read_ids`, with the ids' unsigned crc32 in place of the ids, which then never leave their task."""
    files = spark.read.parquet(path)
    id_type = files.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, names, content in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                ids, lengths = unpack(content)
                raw, ends = memoryview(ids.tobytes()), np.cumsum(lengths.astype("i8"))
                starts = ends - lengths.astype("i8")
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * n, pa.int32()),
                        pa.array([number] * n, pa.int32()),
                        pa.array(names, batch.schema.field("docs").type.value_type),
                        pa.array(starts, pa.int64()),
                        pa.array(lengths.astype("i8"), pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "segment", "id", "inside", "n_tokens", "ids_crc32"],
                )

    opened = files.select("part", "segment", "docs", "content").mapInArrow(
        run, f"part int, segment int, id {id_type}, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return _placed(files, opened).select(F.col("id").alias(id), "start", "n_tokens", "ids_crc32")


@query("op8_token_planes")
def op8(spark, sf_dir):
    import public_tokenizers

    path = fresh_dir(spark, "token-planes")
    write_ids(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path)
