"""Filter interaction audit: what each filter removes at each step of every order of the filters.

Every document is reduced to one bit per filter (set: it fails). Counts of documents by part and bits are a
tensor of 2x2x2x2x2 cells a part, whatever the part's size. On each axis a step asks for the documents that pass, that
fail, or all of them, so one contraction of the tensor with the 3x2 table of these choices on every axis
(`einsum`) yields what every step of every order reads.

The filter for copies needs other documents: a document passes it whose id is the least with its text's digest. Those
documents are counted apart; all others fail it. The least id is a combinable minimum and the documents are found again
by digest and id, so a text that a third of all documents hold is never gathered. Only ids, digests and bits move.

A null text is empty; a null id is larger than all others; of rows with equal text and equal least id none is a copy.
A null part and the part named by the empty string are one. Several labels of a document count as one that is
good (bad) if any is. Repeated rows count each. An empty table has no parts and gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.llm.exact_dedup import digest_of
from regmill.llm.registry import SPACES, documents, let, query
from regmill.session import written

FILTERS = "ABCDE"
MARKS = "#$%&*|"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTED = ("n", "good", "toxic")
CHOICES = np.array([[1, 0], [0, 1], [1, 1]], np.int64)  # pass, fail, all
PASS, FAIL, ALL = range(3)
PARTS = 64  # tensors contracted at once


def text_fails(text: Column) -> list[Column]:
    """Of the filters that need the text alone, whether it fails them."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.translate(whole, SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    capitals = F.length(whole) - F.length(F.translate(whole, UPPER, ""))
    marks = F.length(F.translate(whole, MARKS, "")) < F.length(whole)
    both = let(
        counts, lambda c: F.struct((c["n"] < 200).alias("short"), (100 * c["d"] < 50 * c["n"]).alias("repeats"))
    )
    return [both, 100 * capitals > 2 * F.length(whole), marks]


def cells(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, bits (bit k: filter k fails) and the documents there: n, good and toxic."""
    words, capitals, marks = text_fails(F.col(text))
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        digest_of(F.col(text)).alias("digest"),
        words.alias("words"),
        capitals.alias("capitals"),
        marks.alias("marks"),
    )
    fails = (F.col("words.short"), F.col("words.repeats"), F.col("capitals"), F.col("marks"))
    bits = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))
    # repeated rows become one before anything is dealt out
    rows = rows.groupBy("id", "part", "digest", bits.alias("bits")).agg(F.count("*").alias("n"))
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
    )
    counted = rows.join(marked, "id", "left").select(
        "id",
        "part",
        "digest",
        "bits",
        "n",
        (F.coalesce("good", F.lit(0)) * F.col("n")).alias("good"),
        (F.coalesce("bad", F.lit(0)) * F.col("n")).alias("toxic"),
    )
    counted = written(counted, "filter-bits")
    # null ids come after all others
    least = counted.groupBy("digest").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id"))["id"].alias("id"))
    first = counted.alias("a").join(
        least.alias("b"), (F.col("a.digest") == F.col("b.digest")) & F.col("a.id").eqNullSafe(F.col("b.id")), "left_semi"
    )
    copy = 1 << FILTERS.index("E")
    # all documents as copies, but the first ones taken out there and put where they pass
    taken = first.select("part", (F.col("bits") + copy).alias("bits"), *[(-F.col(c)).alias(c) for c in COUNTED])
    put = first.select("part", "bits", *COUNTED)
    everything = counted.select("part", (F.col("bits") + copy).alias("bits"), *COUNTED)
    moved = taken.unionByName(put).unionByName(everything)
    return moved.groupBy("part", "bits").agg(*[F.sum(c).alias(c) for c in COUNTED])


def contractions(tensors: np.ndarray) -> np.ndarray:
    """Of tensors (..., 2, 2, 2, 2, 2) the counts for every choice of pass, fail or all on each axis."""
    return np.einsum("...abcde,ia,jb,kc,ld,me->...ijklm", tensors, *[CHOICES] * len(FILTERS))


def steps(table: np.ndarray) -> Iterator[tuple]:
    """filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley of one part.

    `table` holds the contractions of the three counts: [count, choice of A, ..., choice of E].
    """

    def read(count: str, chosen: dict[str, int], rest: int) -> int:
        return int(table[(COUNTED.index(count), *(chosen.get(f, rest) for f in FILTERS))])

    orders = ["".join(p) for p in permutations(FILTERS)]
    shapley = dict.fromkeys(FILTERS, 0)
    rows = []
    for order in orders:
        passed: dict[str, int] = {}
        for k, f in enumerate(order):
            here = passed | {f: FAIL}
            removed = read("n", here, ALL)
            shapley[f] += removed
            lost = [read(c, here, ALL) for c in COUNTED[1:]]
            failing = read("n", {f: FAIL}, ALL)
            passed = passed | {f: PASS}
            kept = read("n", passed, ALL)
            rows.append((order, k + 1, kept, removed, failing - removed, read("n", {f: FAIL}, PASS), *lost, f))
    for *row, f in rows:
        yield (*row, shapley[f])


RESULT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counted cells (part, bits, n, good, toxic)."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("bits", *COUNTED)).alias("cells"))  # at most 32 a part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        names = [f.split(" ")[0] for f in RESULT.split(", ")]
        for whole in batches:
            for at in range(0, whole.num_rows, PARTS):
                batch = whole.slice(at, PARTS).to_pylist()
                flat = np.zeros((len(batch), len(COUNTED), 1 << len(FILTERS)), np.int64)
                for k, row in enumerate(batch):
                    for cell in row["cells"]:
                        flat[k, :, cell["bits"]] = [cell[c] for c in COUNTED]
                # bit 0 is filter A: the last axis of the reshaped cells, so axes are turned round
                tensors = flat.reshape(len(batch), len(COUNTED), *[2] * len(FILTERS)).transpose(0, 1, 6, 5, 4, 3, 2)
                for row, table in zip(batch, contractions(tensors), strict=True):
                    made = list(zip(*steps(table), strict=True))
                    columns = [[row["part"]] * len(made[0]), *made]
                    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    return parts.mapInArrow(run, RESULT)


def filter_audit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    return audit(cells(docs, labels, id, text, part))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
b AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > m, m IS NOT NULL)::INT AS bits
  FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS m FROM d) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM b GROUP BY part, bits),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(f, bit)),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit,
         coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier
  FROM o, range(1, 6) AS r(step)),
x AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN c.bits & (earlier + bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN c.bits & earlier = 0 AND c.bits & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN c.bits & earlier <> 0 AND c.bits & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN c.bits = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN c.bits & earlier = 0 AND c.bits & bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN c.bits & earlier = 0 AND c.bits & bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM x
"""


@query("op12_filter_audit", SQL)
def op12(spark, sf_dir):
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
