"""Jaccard join of documents by word n-grams, as a blocked sparse product with size bounds.

The document by n-gram incidence matrix times its transpose holds the overlaps. The product is cut down by
bounds that follow from the sizes: sets of n and m n-grams can only link when 100 min >= percent max,
and when n-grams are ordered, rare ones first, linked sets share one among the first n - ceil(percent n / 100) + 1
of each. The order is by a count sketch of fixed size over the whole corpus, ties by hash; any order is exact.

 1. one pass counts all n-grams in the sketch (fixed size, broadcast);
 2. one pass writes per row the size, a 64-bit digest of the set and the leading n-grams; rows of equal sets are
    one node, so copies never multiply;
 3. leading n-grams that two nodes or more hold give the blocks of columns (`shared_keys`);
 4. columns of at most FEW nodes give pairs; those whose sets end too soon after the shared n-gram to overlap
    enough are discarded, the others verified once on the whole sets, the first set of a pair being
    built once for all its partners;
 5. columns of more nodes are near-copies by the thousand: nodes connected by such columns form a group, cut by size
    class and hash into blocks of about BLOCK nodes. Every two blocks whose sizes can link are one tile;
    a task accumulates the tile's overlaps, n-gram block by n-gram block, and returns one row a node: a
    peer that connects it and the number of its links. Pairs are never emitted;
 6. links and peers are joined to components (`components`).

Nodes and n-grams are identified by 64-bit hashes. A null or empty text, or one without words, has no n-grams, links
with nothing and is a component of its own. Null ids never name a component unless no other id does. Equal rows give equal results. An
empty table gives an empty result. Only the id and the text are read; stages carry all other columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.llm import shared_keys
from regmill.llm.components import components
from regmill.llm.hashing import Shingler, blocks
from regmill.llm.registry import documents, query
from regmill.session import written

SKETCH_BITS = 22
SKETCH_PIECES = 64
FEW = 64
BLOCK = 1024
DENSE = 24  # n-grams of more nodes in a tile go through the dense product
COLUMNS = 4096
BUCKET = 1 << 18  # leading n-grams of a bucket
FILES = 8  # of a small table; larger ones have a file for each BUCKET of leading n-grams
_COUNTS = ("u1", "<u2", "<u4", "<u8")


def _bytes(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _packed_counts(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold them all, compressed; the first byte names the width."""
    width = next(k for k, kind in enumerate(_COUNTS) if counts.max(initial=0) <= np.iinfo(kind).max)
    return bytes([width]) + zstandard.compress(counts.astype(_COUNTS[width]).tobytes(), 1)


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed[1:]), _COUNTS[packed[0]]).astype(np.int64)


def count_sketch(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """How often n-grams of each of 2^SKETCH_BITS classes occur: fixed size, added up in tasks."""
    size = (1 << SKETCH_BITS) // SKETCH_PIECES

    def rows(pieces: dict[int, np.ndarray]) -> pa.RecordBatch:
        counts = pa.array([_packed_counts(c) for c in pieces.values()], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.int32()), counts], ["piece", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(width), np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            texts = _bytes(batch, 0)
            for a, b in blocks([len(t) for t in texts]):
                found = np.concatenate(list(shingler.windows(texts[a:b])))
                np.add.at(total, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            yield rows(dict(enumerate(np.split(total, SKETCH_PIECES))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pieces[piece] = pieces.get(piece, 0) + _counts(counts)
        if pieces:
            yield rows(pieces)

    packed = "piece int, counts binary"
    parts = docs.select(text).mapInArrow(count, packed).repartition("piece").mapInArrow(add, packed)
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    for row in parts.collect():  # SKETCH_PIECES rows
        total[row["piece"] * size : (row["piece"] + 1) * size] = _counts(row["counts"])
    return np.minimum(total, 2**32 - 1).astype(np.uint32)


def row_key(id: Column, text: Column) -> Column:
    return F.xxhash64(id, text)


def signatures(docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    """id, row (hash of id and text), n (size), node (null for an empty set) and the leading n-grams of every row."""
    sketch = docs.sparkSession.sparkContext.broadcast(count_sketch(docs, text, width))
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            sizes, nodes, leading, edges = [], [], [], [0]
            for grams in shingler.sets(_bytes(batch, 2)):
                n = len(grams)
                keep = n - -(-percent * n // 100) + 1 if n else 0
                counts = sketch.value[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                sizes.append(n)
                digest = hashlib.blake2b(grams.tobytes(), digest_size=8).digest()
                nodes.append(int.from_bytes(digest, "little", signed=True) if n else None)
                leading.append(grams[np.argsort(counts, kind="stable")[:keep]])
                edges.append(edges[-1] + keep)
            flat = np.concatenate(leading).view(np.int64) if leading else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int32()),
                    pa.array(nodes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat)),
                ],
                ["id", "row", "n", "node", "leading"],
            )

    rows = docs.select(F.col(id).alias("id"), row_key(F.col(id), F.col(text)).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, row bigint, n int, node bigint, leading array<bigint>")


def leading_entries(rows: DataFrame) -> int:
    """How many leading n-grams the rows have, one at least for each row with a node."""
    return rows.where("node is not null").agg(F.sum(F.size("leading").cast("long"))).first()[0] or 0


def shared_columns(rows: DataFrame, entries: int) -> DataFrame:
    """key, node, n, place: the leading n-grams that two nodes or more hold, with their place in the node's order."""
    buckets = shared_keys.buckets_of(entries, BUCKET)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(2)
            times = np.diff(grams.offsets.to_numpy())
            keys = grams.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), times)
            sizes = np.repeat(batch.column(1).to_numpy(zero_copy_only=False).astype("<i8"), times)
            places = np.arange(len(keys)) - np.repeat(np.cumsum(times) - times, times)
            yield from shared_keys.pack(keys, nodes, sizes << 32 | places, buckets)

    packed = rows.where("node is not null").select("node", "n", "leading").mapInArrow(run, shared_keys.PACKED)
    n, place = F.shiftright("extra", 32).cast("int"), F.col("extra").bitwiseAND(0xFFFFFFFF).cast("int")
    return shared_keys.shared(packed).select("key", F.col("owner").alias("node"), n.alias("n"), place.alias("place"))


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """node, n, copies, text of the wanted nodes (a column `node`): the text of each node's first row."""
    first = nodes.join(wanted, "node").select("node", "n", "copies", "row")
    rows = docs.select(row_key(F.col(id), F.col(text)).alias("row"), F.col(text).alias("text"))
    return rows.join(first, "row").dropDuplicates(["row"]).drop("row")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """node, peer, links: both directions of the pairs (a, b) that link; links counts the peer's rows.

    The rows of a come together, its own text first; a task holds the sets of one pair.
    """
    own = texts.join(pairs.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
    own = own.select(F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "copies", "text")
    others = pairs.join(texts.withColumnRenamed("node", "b"), "b").select("a", "b", "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, left, mine, my_copies = Shingler(width), None, None, 0
        for batch in batches:
            names = [batch.column(k).to_pylist() for k in range(3)]
            out = []
            for a, b, copies, grams in zip(*names, shingler.sets(_bytes(batch, 3)), strict=True):
                if b is None:
                    left, mine, my_copies = a, grams, copies
                elif left == a:
                    overlap = len(np.intersect1d(mine, grams, assume_unique=True))
                    if 100 * overlap >= percent * (len(mine) + len(grams) - overlap):
                        out += [(a, b, copies), (b, a, my_copies)]
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "peer", "links"])

    together = own.unionByName(others).repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first())
    return together.mapInArrow(run, "node bigint, peer bigint, links bigint")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of overlap sizes of the sets, summed over blocks of n-grams."""
    m = len(sets)
    grams = np.concatenate(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, rows = grams[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    held = np.diff(np.append(starts, len(grams)))
    total = np.zeros((m, m), np.float32)
    for k in range(2, DENSE + 1):
        at = starts[held == k]
        if len(at):
            members = rows[at[:, None] + np.arange(k)]
            i, j = np.triu_indices(k, 1)
            pairs = (members[:, i] * m + members[:, j]).ravel()
            total += np.bincount(pairs, minlength=m * m).reshape(m, m).astype(np.float32)
    total += total.T
    frequent = np.flatnonzero(held > DENSE)
    for a in range(0, len(frequent), COLUMNS):
        part = frequent[a : a + COLUMNS]
        column = np.repeat(np.arange(len(part)), held[part])
        places = np.repeat(starts[part], held[part]) + np.arange(len(column)) - np.repeat(
            np.cumsum(held[part]) - held[part], held[part]
        )
        block = np.zeros((m, len(part)), np.float32)
        block[rows[places], column] = 1
        total += block @ block.T
    return total


def tile_links(nodes: np.ndarray, sides: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], percent: int):
    """(node, peer, links) of the nodes that link within a tile: peer connects the node to a least one.

    With two sides only pairs across count: those within a side are another tile's.
    """
    sizes = np.array([len(s) for s in sets], float)
    both = overlaps(sets).astype(float)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(linked, False)
    if sides.any() and not sides.all():
        linked &= sides[:, None] != sides[None, :]
    links = linked @ copies.astype(float)
    label = np.arange(len(nodes))
    while True:  # least label among neighbours, then the label's label, until nothing changes
        spread = np.minimum(label, np.where(linked, label[None, :], len(nodes)).min(1, initial=len(nodes)))
        spread = spread[spread]
        if (spread == label).all():
            break
        label = spread
    has = np.flatnonzero(links > 0)
    return nodes[has], nodes[label[has]], links[has].astype(np.int64)


def tiled(groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """node, peer, links of the groups (node, group, n, copies), tile by tile; a group of at most BLOCK is one tile."""
    step = max(math.log(100 / percent) * 1.001, 1e-9)
    placed = groups.withColumn("size", F.floor(F.log(F.col("n").cast("double")) / step))
    totals = placed.groupBy("group").agg(F.count("*").alias("total"))
    counts = placed.groupBy("group", "size").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    above = counts.select("group", (F.col("size") - 1).alias("size"), F.col("parts").alias("above"))
    below = counts.select("group", (F.col("size") + 1).alias("size"), F.col("parts").alias("below"))
    counts = counts.join(above, ["group", "size"], "left").join(below, ["group", "size"], "left")
    counts = counts.join(totals, "group")
    placed = placed.join(counts, ["group", "size"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))

    def tile(low: Column, i: Column, high: Column, j: Column, side: Column) -> Column:
        return F.struct(
            low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), side.cast("boolean").alias("side")
        )

    def numbers(count: str) -> Column:
        n = F.coalesce(F.col(count), F.lit(0))
        return F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))

    size, part = F.col("size"), F.col("part")
    same = F.transform(
        numbers("parts"),
        lambda k: tile(size, F.least(part, k), size, F.greatest(part, k), part > k),
    )
    up = F.transform(numbers("above"), lambda k: tile(size, part, size + 1, k, F.lit(False)))
    down = F.transform(numbers("below"), lambda k: tile(size - 1, k, size, part, F.lit(True)))
    zero = F.lit(0).cast("long")
    one = F.array(tile(zero, zero, zero, zero, F.lit(False)))
    tiles = F.when(F.col("total") <= BLOCK, one).otherwise(F.concat(same, up, down))
    rows = placed.select("group", F.explode(tiles).alias("t"), "node", "copies")
    rows = rows.select("group", "t.low", "t.i", "t.high", "t.j", "t.side", "node", "copies")
    rows = rows.join(texts.select("node", "text"), "node")

    def run(table: pa.Table) -> pa.Table:
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        sides = table.column("side").to_numpy()
        texts = [x or b"" for x in table.column("text").cast(pa.binary()).to_pylist()]
        found = tile_links(nodes, sides, copies, list(Shingler(width).sets(texts)), percent)
        return pa.table(dict(zip(["node", "peer", "links"], found, strict=True)))

    keys = ["group", "low", "i", "high", "j"]
    return rows.groupBy(*keys).applyInArrow(run, "node bigint, peer bigint, links bigint")


def jaccard_join(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (least id it reaches by links), n_links (rows it links to)."""
    return _joined(docs, id, text, width, percent).drop("row")


def _joined(docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    rows = written(signatures(docs, id, text, width, percent), "signatures")
    # tables of numbers per node, n-gram, link or edge follow the leading n-grams; what holds texts follows Spark's partitions
    entries = leading_entries(rows)
    files = max(FILES, shared_keys.buckets_of(entries, BUCKET))
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("label"),
        F.first("n").alias("n"),
        F.min_by("row", F.struct("id", "row")).alias("row"),
        F.count("*").alias("copies"),
    )
    nodes = written(nodes, "nodes", files)
    columns = written(shared_columns(rows, entries), "columns", files)
    held = columns.groupBy("key").agg(F.count("*").alias("held"), F.min("node").alias("center"))

    # groups: what columns of many nodes connect
    frequent = held.where(F.col("held") > FEW).select("key", "center")
    star = columns.join(frequent, "key").where("node != center").select(F.col("center").alias("a"), F.col("node").alias("b"))
    groups = components(star.distinct(), files).withColumnRenamed("root", "group")
    groups = written(groups.join(nodes.select("node", "n", "copies"), "node"), "groups", files)

    # pairs: nodes that a column of few nodes holds and that no group holds together
    few = columns.join(held.where(F.col("held") <= FEW).select("key"), "key")
    few = few.join(groups.select("node", "group"), "node", "left")
    other = few.select(
        "key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("place").alias("at"), F.col("group").alias("other")
    )
    # overlap is at most what follows the first shared n-gram on either side; linked pairs need percent (n + m) / (100 + percent)
    left = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("at")).cast("long")
    pairs = few.withColumnRenamed("node", "a").join(other, "key").where("a < b")
    pairs = pairs.where(F.col("group").isNull() | F.col("other").isNull() | (F.col("group") != F.col("other")))
    pairs = pairs.where((100 + percent) * left >= percent * (F.col("n").cast("long") + F.col("m")))
    pairs = written(pairs.select("a", "b").distinct(), "pairs", files)

    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    wanted = wanted.unionByName(groups.select("node")).distinct()
    texts = written(_texts(docs, nodes, wanted, id, text), "texts")
    links = verified(pairs, texts, width, percent).unionByName(tiled(groups, texts, width, percent))
    # sets are compared in as many tasks as there are; only what they found is gathered
    links = written(links.repartition("node"), "links", files)
    reached = components(links.where("node != peer").select(F.col("node").alias("a"), F.col("peer").alias("b")), files)
    named = reached.join(nodes.select("node", "label"), "node")
    names = named.groupBy("root").agg(F.min("label").alias("component_id"))
    classes = reached.join(names, "root").select("node", "component_id")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (
        nodes.join(classes, "node", "left")
        .join(counts, "node", "left")
        .select(
            "node",
            F.coalesce("component_id", "label").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    return (
        rows.select("id", "row", F.col("n").cast("long").alias("n_shingles"), "node")
        .join(classes, "node", "left")
        .select(
            F.col("id").alias(id),
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            "row",
        )
    )


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of each component's least id, and every row without n-grams; all columns of `docs`.

    Rows of one id are one document and stay together. Only rows that must go are listed and joined.
    """
    found = _joined(docs, id, text, width, percent)
    gone = "_row"
    while gone.lower() in {name.lower() for name in docs.columns}:
        gone += "_"
    drop = found.where(~F.col(id).eqNullSafe(F.col("component_id"))).select(F.col("row").alias(gone)).distinct()
    return docs.join(drop, row_key(F.col(id), F.col(text)) == F.col(gone), "left_anti")


@query("op2_ngram_jaccard")
def op2(spark, sf_dir):
    return jaccard_join(documents(spark, sf_dir), width=4, percent=85)
