"""Prediction by partial matching against a coder that learns and codes one byte after the other."""

import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from regmill.llm import ppm, queries

SF = "/root/testdata/sf0.001"


class Coder:
    def __init__(self, order):
        self.order, self.tables = order, defaultdict(Counter)

    def contexts(self, text):
        data = b"\xff" * self.order + text.lower() + b"\xff"
        for i in range(self.order, len(data)):
            yield [data[i - k : i] for k in range(self.order, -1, -1)], data[i]

    def learn(self, text):
        for contexts, byte in self.contexts(text):
            for context in contexts:
                known = byte in self.tables[context]
                self.tables[context][byte] += 1
                if known:
                    break

    def code(self, text):
        total = 0.0
        for contexts, byte in self.contexts(text):
            excluded = set()
            for context in contexts:
                left = {b: n for b, n in self.tables.get(context, {}).items() if b not in excluded}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if byte in left:
                    total += math.log10(left[byte] / whole)
                    break
                total += math.log10(len(left) / whole)
                excluded |= set(left)
            else:
                total -= math.log10(256 - len(excluded))
        return total


def brute(rows, order, held):
    """(id, text) -> held_out, n_tokens, n_known, train_tokens, base_score, score."""
    coder, counts = Coder(order), Counter()
    tokens = lambda t: [*re.findall(rb"[^\x20\x09-\x0D]+", t.lower()), None]
    for doc, text in rows:
        if not held(doc):
            coder.learn(text)
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((doc, held(doc), len(own), sum(counts[t] > 0 for t in own), n, base, coder.code(text)))
    return out


def mod7(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


def test_query_equals_coder(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op11_lm_score"](spark, SF).collect()
    same(got, brute([(d, (t or "").encode()) for d, t in rows], ppm.ORDER, mod7))


@pytest.mark.parametrize("order,block", [(1, 10**6), (2, 200), (6, 3000)])
def test_edges(spark, strange, order, block):
    # ids held out that have bytes, contexts and words of their own
    got = ppm.score(strange, F.col("doc_id").isin(3, 4, 9, 10), order=order, block_bytes=block).collect()
    rows = [(r.doc_id, (r.text or "").encode()) for r in strange.collect()]
    same(got, brute(rows, order, lambda d: d in (3, 4, 9, 10)))


def test_nothing_to_learn_or_score(spark, strange):
    assert ppm.score(strange.where("false"), F.lit(True)).count() == 0
    got = ppm.score(strange, F.lit(True)).collect()
    assert all(r.train_tokens == r.n_known == 0 and r.base_score == 0 for r in got)
    empty = [r for r in got if r.doc_id in (4, 5)]
    assert all(r.score == pytest.approx(-math.log10(256)) for r in empty)


def test_codes_of_a_context_sum_to_one(spark):
    """Whatever came before, the probabilities of the 256 bytes add up to one."""
    order = 2
    texts = [b"banana band", b"bandana", b"an apple"]
    packed, node = ppm.strings(texts, order)
    counts = spark.createDataFrame(
        [(int(s), int(n)) for s, n in zip(packed, np.bincount(node), strict=True)], "string bigint, n bigint"
    )
    nodes = ppm.trie(counts, order)
    for context in (b"an", b"na", b"xa", b"zz", b"\xff\xff"):
        first = int.from_bytes(context, "big") << 8
        asked = spark.range(first, first + 256).select(F.col("id").alias("string")).join(counts, "string", "left").fillna(0)
        codes = ppm.string_codes(asked, nodes, order).where(F.shiftright("string", 8) == first >> 8).collect()
        assert len(codes) == 256 and sum(10**r.value for r in codes) == pytest.approx(1)


def test_levels_beyond_the_table_are_sorted(monkeypatch):
    texts = [b"", b"abcabc", bytes(range(1, 250)) * 3, b"abd"]
    want = ppm.strings(texts, 3)
    monkeypatch.setattr(ppm, "TABLE", 64)
    got = ppm.strings(texts, 3)
    assert np.array_equal(want[0], got[0]) and np.array_equal(want[1], got[1])


class Grouped:
    """Stands for a frame whose groups are given to a function: keeps the function."""

    def groupBy(self, *_):
        return self

    def cogroup(self, _):
        return self

    def applyInArrow(self, function, _):
        return function


def block(size):
    """A block of about so many bytes in texts of 2,000 over 1,000 words."""
    picks = np.random.default_rng(1).integers(0, 1000, (size // 2000, 333))
    texts = [" ".join(f"w{n:04}" for n in row) for row in picks.tolist()]
    n = len(texts)
    return pa.table({"block": pa.array([0] * n, pa.int32()), "id": range(n), "held_out": [i % 7 == 2 for i in range(n)], "text": texts})


def replies(found, words):
    """What comes back for a block: 1 for every string, its number of learning rows for every word."""
    kind = [True] * len(found) + [False] * len(words)
    key = np.concatenate([found["string"].to_numpy(), words["place"].to_numpy().astype(np.int64)])
    value = np.concatenate([np.ones(len(found)), words["n"].to_numpy().astype(float)])
    return pa.table({"is_string": kind, "key": key, "value": value, "fresh": np.zeros(len(key), np.int32)})


def traced(function, *tables):
    """The result, and the most bytes that were allocated meanwhile."""
    tracemalloc.start()
    result = function(*tables)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return result, most


def test_a_block_holds_little_next_to_its_texts():
    """What a step allocates does not follow a block's bytes when the strings and words in it stay the same."""
    small, large = block(3_000_000), block(9_000_000)
    more = large.nbytes - small.nbytes
    for step in (ppm._block_strings(Grouped(), 4), ppm._block_words(Grouped())):
        assert traced(step, large)[1] - traced(step, small)[1] < 0.5 * more
    step, most = ppm._add_up(Grouped(), Grouped(), "bigint", 4), []
    for table in (small, large):
        found, words = ppm._block_strings(Grouped(), 4)(table), ppm._block_words(Grouped())(table)
        sums, bytes_ = traced(step, table, replies(found, words))
        assert sums["score"].to_pylist() == [len(t) + 1 for t in table["text"].to_pylist()]
        assert len(words) == 1001 and set(sums["n_tokens"].to_pylist()) == {334}
        most.append(bytes_)
    assert most[1] - most[0] < 0.5 * more


def test_runs_of_a_block_are_merged(monkeypatch):
    table = block(20_000).append_column("more", pa.array(range(10)))
    whole = [ppm._block_strings(Grouped(), 2)(table), ppm._block_words(Grouped())(table)]
    monkeypatch.setattr(ppm, "RUN_BYTES", 1)
    assert [ppm._block_strings(Grouped(), 2)(table), ppm._block_words(Grouped())(table)] == whole
    counts = Counter()
    for text, held in zip(table["text"].to_pylist(), table["held_out"].to_pylist(), strict=True):
        counts.update({w.encode(): 0 if held else n for w, n in Counter(text.split()).items()})
    assert dict(zip(whole[1]["word"].to_pylist(), whole[1]["n"].to_pylist(), strict=True)) == {**counts, b"": 8}


def test_strings_by_table_are_the_sorted_ones(monkeypatch):
    texts = [b"", b"abcabc", b"a", b"cab"]
    want = ppm.strings(texts, 2)
    monkeypatch.setattr(ppm, "TABLE", 1)
    got = ppm.strings(texts, 2)
    assert np.array_equal(want[0], got[0]) and np.array_equal(want[1], got[1])
    assert [got[0][i].item().to_bytes(3, "big") for i in got[1][:4]] == [b"\xff\xff\xff", b"\xff\xffa", b"\xffab", b"abc"]
