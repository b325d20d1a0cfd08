"""Language-model scores by prediction by partial matching, pretrained on a part of the documents.

The model is a trie of byte contexts of 0..`order` bytes. A text's code length is the sum over its bytes and its
end (byte 0xFF, which UTF-8 does not know and which also fills the context before a text). A byte is coded at the
longest context that the trie holds; where it is not known there, an escape leads to the context one byte shorter, in which
the bytes known above are excluded. With n counts of d different bytes left in a context, a byte counted c times has
probability c / (n + d) and the escape d / (n + d) (method C); no escape is paid where nothing is left. Below the
empty context all bytes left are equally likely. Shorter contexts count a byte once for each longer context that
has it, as an adaptive coder with update exclusion counts them, so counts do not depend on the order of the documents.

 1. documents are dealt by hash into blocks of bounded bytes. The different strings of `order` + 1 bytes in a block's texts
    are found in runs of texts and merged, so that next to the texts only the different ones are held;
 2. the strings are counted over all blocks, and the trie is made from these counts by Spark, a level at a time;
 3. every different string gets its code length once; strings and words of a block are joined with their values,
    and the block's texts add them up. Nothing but the levels of at most one byte (257 contexts) is broadcast.

The baseline scores words by add-one frequencies, learnt from the same documents; its tokens are lower-cased words and one
end per text. Words travel as they are; within a block they are told apart by a 64-bit hash.

A null text is empty: one end. Null ids hash as no digits and so are learnt from. Repeated rows count and are scored each
(those equal in id and text share a block). Without learning rows all bytes are equally likely. An empty table gives an
empty result, other columns are not read. A task needs memory for a block's bytes, its different strings and words, and
some 50 bytes for each of a run's bytes; a block is at least one text, and so is a run.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regmill.llm.hashing import Shingler, blocks
from regmill.llm.registry import documents, query
from regmill.session import written

ORDER = 4
BLOCK_BYTES = 16_000_000
END = 0xFF
LEAST_ORDER, MOST_ORDER = 1, 6  # a string of 7 bytes fits a bigint
RUN_BYTES = 500_000  # of a block's texts that are walked at once
TABLE = 1 << 20  # entries of an array of all strings over a run's bytes; beyond it the strings are sorted
FILE_ROWS, LEAST_FILES = 262_144, 8  # tables of the trie: a file for so many strings, so many files at least
SHARED_LEVELS = 2  # levels of 0 and 1 bytes are broadcast


# --- a block's strings and words ------------------------------------------------------------------------


def strings(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The different strings of order + 1 bytes that end at a byte or the end of a text, as numbers in rising order,
    and for every byte and end of every text the place of its string.
    """
    if not texts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = bytes([END]) * order
    codes = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    alphabet = np.flatnonzero(np.bincount(codes, minlength=256))
    size, width = len(codes) - order, len(alphabet)
    packed = np.zeros(size, np.int64)
    table = width ** (order + 1) <= TABLE
    if table:
        dense = np.cumsum(np.bincount(alphabet, minlength=256)) - 1
        for k in range(order + 1):
            packed = packed * width + dense[codes[k : k + size]]
    else:
        for k in range(order + 1):
            packed = (packed << 8) | codes[k : k + size]
    if order > 1:
        # the gap after a text is its end and order - 1 bytes that are context only
        after = np.cumsum([len(t) + order for t in texts])
        only = (after[:, None] - np.arange(1, order)).ravel()
        packed = np.delete(packed, only)
    if not table:
        return np.unique(packed, return_inverse=True)
    seen = np.zeros(width ** (order + 1), bool)
    seen[packed] = True
    fresh, number = np.flatnonzero(seen), np.cumsum(seen, dtype=np.int32) - np.int32(1)
    full = np.zeros(len(fresh), np.int64)
    for k in range(order, -1, -1):
        full = (full << 8) | alphabet[fresh // width**k % width]
    return full, number[packed]


def _runs(table: pa.Table) -> Iterator[tuple[int, int, list[bytes]]]:
    """The block's texts in lower case, in runs of bounded bytes. Strings and words are ranked over the whole block, so the
    order of the rows is free to change between jobs."""
    texts = table.column("text").cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy() + 1
    for a, b in blocks(sizes.tolist(), RUN_BYTES):
        yield a, b, [(x or b"").lower() for x in texts.slice(a, b - a).to_pylist()]


def _learn(table: pa.Table) -> np.ndarray:
    return ~table.column("held_out").to_numpy().astype(bool)


def _merged(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in rising order with their counts added up. Parts wait until they are as many as the different keys."""
    keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

    def merge() -> None:
        # arrays go as soon as they are used: in texts of many different strings these are the largest
        every = np.concatenate(keys)
        keys.clear()
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.append(len(every) > 0, every[1:] != every[:-1]))
        keys.append(every[first])
        del every
        n = np.concatenate(counts)
        counts.clear()
        n = n[order]
        del order
        counts.append(np.add.reduceat(n, first) if len(first) else n)

    for more, n in parts:
        keys.append(more)
        counts.append(n)
        if sum(map(len, keys[1:])) > len(keys[0]):
            merge()
    merge()
    return keys[0], counts[0]


def _joined(keys: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The different ones of both in rising order (np.union1d hashes numbers, which takes many times as long)."""
    keys = np.sort(np.concatenate([keys, more]))
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _words(shingler: Shingler, texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Hashes of the different words of a run in rising order, the words, for every word its place among them, and the number
    of words of each text."""
    found, counts = shingler.words(texts)
    hashes, first, places = np.unique(found, return_index=True, return_inverse=True)
    joined = b" ".join(texts) + b" "
    codes = np.frombuffer(joined, np.uint8)
    inside = np.concatenate([[False], (codes != 32) & ((codes < 9) | (codes > 13))])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[0::2][first].tolist(), edges[1::2][first].tolist()
    return hashes, pa.array([joined[a:b] for a, b in zip(begin, end, strict=True)], pa.binary()), places, counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the values over runs of these lengths, of which some may be 0."""
    out, some = np.zeros(len(counts)), counts > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some])
    return out


def _block_strings(docs: DataFrame, order: int) -> DataFrame:
    """block, string and n: how often learning rows have it."""

    def run(table: pa.Table) -> pa.Table:
        learn = _learn(table)

        def counted():
            for a, b, texts in _runs(table):
                packed, node = strings(texts, order)
                yield packed, np.bincount(node[np.repeat(learn[a:b], [len(t) + 1 for t in texts])], minlength=len(packed))

        packed, n = _merged(counted())
        return pa.table({"block": np.full(len(packed), table.column("block")[0].as_py(), np.int32), "string": packed, "n": n})

    return docs.groupBy("block").applyInArrow(run, "block int, string bigint, n bigint")


def _block_words(docs: DataFrame) -> DataFrame:
    """block, place, word and n: how often learning rows have it. Places are ranks of the words' hashes; the end comes last, as
    the empty word."""

    def run(table: pa.Table) -> pa.Table:
        shingler, learn = Shingler(1), _learn(table)
        hashes, found, n = [], [], []
        for a, b, texts in _runs(table):
            some, theirs, places, counts = _words(shingler, texts)
            hashes.append(some)
            found.append(theirs)
            n.append(np.bincount(places[np.repeat(learn[a:b], counts)], minlength=len(some)))
        different, first, places = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        n = np.bincount(places, np.concatenate(n), len(different)).astype(np.int64)
        return pa.table(
            {
                "block": np.full(len(different) + 1, table.column("block")[0].as_py(), np.int32),
                "place": np.arange(len(different) + 1, dtype=np.int32),
                "word": pa.concat_arrays([pa.concat_arrays(found).take(pa.array(first)), pa.array([b""], pa.binary())]),
                "n": np.append(n, learn.sum()),
            }
        )

    return docs.groupBy("block").applyInArrow(run, "block int, place int, word binary, n bigint")


# --- the trie ---------------------------------------------------------------------------------------------


def _suffix(string: Column, size: int) -> Column:
    return string.bitwiseAND(F.lit((1 << 8 * size) - 1))


def trie(counts: DataFrame, order: int) -> DataFrame:
    """The contexts of the strings (string, n > 0) of order + 1 bytes.

    level (bytes), context, n and d of the bytes known in it, counts by byte, and rest_n and rest_d: what is left in the
    context one byte shorter when this one's bytes are excluded.
    """
    # no level has more rows than there are strings
    files = max(LEAST_FILES, math.ceil(counts.count() / FILE_ROWS))
    here, levels = counts, []
    for level in range(order, -1, -1):
        shorter = _suffix(F.col("string"), level)
        # at most 256 strings differ in their first byte only
        same = Window.partitionBy(shorter)
        below = F.count("*").over(same) if level else F.lit(0)
        grouped = here.withColumn("below", below).groupBy(F.shiftright("string", 8).alias("context"))
        contexts = grouped.agg(
            F.sum("n").alias("n"),
            F.count("*").alias("d"),
            F.sum("below").alias("below"),
            F.map_from_entries(F.collect_list(F.struct(_suffix(F.col("string"), 1).cast("int"), "n"))).alias("counts"),
        )
        levels.append(written(contexts, f"contexts-{level}", files))
        if level:
            here = written(here.groupBy(shorter.alias("string")).agg(F.count("*").alias("n")), f"strings-{level}", files)
    levels.reverse()
    out = []
    for level, contexts in enumerate(levels):
        columns = [F.lit(level).alias("level"), "a.context", "a.n", "a.d", "a.counts"]
        if not level:
            nothing = F.lit(None).cast("bigint")
            out.append(contexts.alias("a").select(*columns, nothing.alias("rest_n"), nothing.alias("rest_d")))
            continue
        above = levels[level - 1].select("context", "n", "d")
        above = F.broadcast(above) if level <= SHARED_LEVELS else above
        joined = contexts.alias("a").join(above.alias("b"), _suffix(F.col("a.context"), level - 1) == F.col("b.context"))
        left = [(F.col("b.n") - F.col("a.below")).alias("rest_n"), (F.col("b.d") - F.col("a.d")).alias("rest_d")]
        out.append(joined.select(*columns, *left))
    return written(reduce(DataFrame.unionByName, out), "trie", files)


def _code(path: Column) -> Column:
    """log10 of the probability of a byte, from its contexts that the trie holds, the longest first."""
    start = F.struct(
        F.lit(0.0).alias("value"),
        F.lit(None).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("d"),
        F.lit(False).alias("done"),
    )

    def step(state: Column, node: Column) -> Column:
        # in the longest context nothing is excluded, in the others what the one before it knows
        n, d = F.coalesce(state["n"], node["n"]), F.coalesce(state["d"], node["d"])
        known = node["count"].isNotNull()
        paid = F.when(state["done"] | (d == 0), 0.0).when(known, F.log10(node["count"] / (n + d)))
        return F.struct(
            (state["value"] + paid.otherwise(F.log10(d / (n + d)))).alias("value"),
            node["rest_n"].alias("n"),
            node["rest_d"].alias("d"),
            (state["done"] | known).alias("done"),
        )

    known = F.coalesce(F.try_element_at(path, F.lit(-1))["d"], F.lit(0))
    return F.aggregate(
        path, start, step, lambda s: s["value"] + F.when(s["done"], 0.0).otherwise(-F.log10(256.0 - known))
    )


def string_codes(counts: DataFrame, nodes: DataFrame, order: int) -> DataFrame:
    """string and value (log10 of its last byte's probability) of every string of `counts` (string, n)."""
    learnt = nodes.where(F.col("level") == order).select("context", "n", "d", F.explode("counts").alias("byte", "count"))
    learnt = learnt.select(
        (F.shiftleft("context", 8) + F.col("byte")).alias("string"),
        F.log10(F.col("count") / (F.col("n") + F.col("d"))).alias("value"),
    )
    new = counts.where("n = 0").select("string", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("level"))
    masks = F.array(*[F.lit((1 << 8 * k) - 1).cast("bigint") for k in range(order + 1)])
    new = new.withColumn("context", F.shiftright("string", 8).bitwiseAND(masks[F.col("level")]))

    def visits(rows: DataFrame, table: DataFrame) -> DataFrame:
        found = rows.join(table, ["level", "context"], "left")
        byte = _suffix(F.col("string"), 1).cast("int")
        node = F.struct(
            F.col("level"), F.col("n"), F.col("d"), F.col("rest_n"), F.col("rest_d"), F.col("counts")[byte].alias("count")
        )
        return found.select("string", F.when(F.col("n").isNotNull(), node).alias("node"))

    low, high = F.col("level") < SHARED_LEVELS, F.col("level") >= SHARED_LEVELS
    path = visits(new.where(low), F.broadcast(nodes.where(low))).unionByName(visits(new.where(high), nodes.where(high)))
    path = path.groupBy("string").agg(F.sort_array(F.collect_list("node"), asc=False).alias("path"))
    return learnt.unionByName(path.select("string", _code(F.col("path")).alias("value")))


# --- scores -----------------------------------------------------------------------------------------------


def _add_up(docs: DataFrame, replies: DataFrame, id_type: str, order: int) -> DataFrame:
    """The sums of every row; `fresh`, a block's share of the vocabulary, comes with its first row."""

    def run(table: pa.Table, values: pa.Table) -> pa.Table:
        kind, key = values.column("is_string").to_numpy(), values.column("key").to_numpy()
        value = values.column("value").to_numpy()
        ranks = np.argsort(key[kind])
        known, code = key[kind][ranks], value[kind][ranks]
        by_word = np.empty(len(key) - len(known))
        by_word[key[~kind]] = value[~kind]
        end, shingler, hashes = by_word[-1], Shingler(1), np.empty(0, np.uint64)
        for _, _, texts in _runs(table):
            hashes = _joined(hashes, shingler.words(texts)[0])
        n_words, n_known = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
        base, score = np.zeros(table.num_rows), np.zeros(table.num_rows)
        for a, b, texts in _runs(table):
            packed, node = strings(texts, order)
            score[a:b] = _sums(code[np.searchsorted(known, packed)][node], np.array([len(t) + 1 for t in texts]))
            found, n_words[a:b] = shingler.words(texts)
            different, places = np.unique(found, return_inverse=True)
            of = by_word[np.searchsorted(hashes, different)][places]
            base[a:b] = _sums(of, n_words[a:b])
            n_known[a:b] = _sums((of > 0).astype(float), n_words[a:b])
        fresh = np.zeros(table.num_rows, np.int64)
        fresh[0] = values.column("fresh").to_numpy().sum()
        return pa.table(
            {
                "id": table.column("id"),
                "held_out": table.column("held_out"),
                "n_tokens": n_words + 1,
                "n_known": n_known + int(end > 0),
                "known": base + end,
                "score": score,
                "fresh": fresh,
            }
        )

    schema = f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, known double, score double, fresh bigint"
    return docs.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def score(
    docs: DataFrame,
    held_out: Column,
    id: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; rows held out are not learnt from."""
    if not LEAST_ORDER <= order <= MOST_ORDER:
        raise ValueError(f"order {order} is not in {LEAST_ORDER}..{MOST_ORDER}")
    id_type = docs.schema[id].dataType.simpleString()
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0
    dealt = F.pmod(F.xxhash64(F.col(id), F.col(text)), F.lit(max(1, math.ceil(size / block_bytes)))).cast("int")
    rows = docs.select(
        dealt.alias("block"), F.col(id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text")
    )

    requests = written(_block_strings(rows, order), "block-strings")
    counts = written(requests.groupBy("string").agg(F.sum("n").alias("n")), "strings")
    nodes = trie(counts.where("n > 0"), order)
    by_string = requests.join(string_codes(counts, nodes, order), "string").select(
        "block", F.lit(True).alias("is_string"), F.col("string").alias("key"), "value", F.lit(0).alias("fresh")
    )

    # one row a block and word: the sum needs no second pass, and a frequent word has as many rows as there are blocks
    word = Window.partitionBy("word")
    by_word = _block_words(rows).select(
        "block", "place", F.sum("n").over(word).alias("c"), (F.min("block").over(word) == F.col("block")).alias("first")
    )
    by_word = by_word.select(
        "block",
        F.lit(False).alias("is_string"),
        F.col("place").cast("bigint").alias("key"),
        F.log10(F.col("c") + 1).alias("value"),
        (F.col("first") & (F.col("c") > 0)).cast("int").alias("fresh"),
    )

    sums = written(_add_up(rows, by_string.unionByName(by_word), id_type, order), "sums")
    total = sums.agg(
        F.coalesce(F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))), F.lit(0)).alias("n"),
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("v"),
    ).first()
    return sums.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total["n"]).cast("bigint").alias("train_tokens"),
        (F.col("known") - F.col("n_tokens") * F.lit(math.log10(total["n"] + total["v"] + 1))).alias("base_score"),
        "score",
    )


def fold(id: str, parts: int) -> Column:
    """crc32 of the id's digits, mod `parts`."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % parts


@query("op11_lm_score")
def op11(spark, sf_dir):
    return score(documents(spark, sf_dir), held_out=fold("doc_id", 7) == 2)
