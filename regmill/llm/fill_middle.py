"""Fill-in-the-middle: a text is cut in two places and its middle moved to the end.

Units are runs of ASCII letters and single other characters. Two hashed numbers of units give the cuts; two further
ones decide whether the text stays plain and in which order prefix and suffix come. All of it follows from the
document's id, so reruns and retried tasks agree.

Cuts are found in the UTF-8 bytes. A sparse index of exceptions holds the multibyte characters only: where
each lies and how many bytes it has beyond one. A binary search in it turns byte places into code points and back; in
an ASCII text it is empty and both are the same number.

A null text is the empty text, which stays plain with no units; a text that holds a sentinel stays plain, so what is not
plain can always be taken apart again. A null id hashes as no digits. Equal rows give equal results; texts are never
cut short, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.llm.registry import documents, query

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
BLOCK_TEXTS = 512  # texts of an Arrow batch that is made at once

_LETTER = np.zeros(256, bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
# bytes of the character that a lead byte opens, beyond the first
_EXCESS = np.zeros(256, np.uint8)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class Exceptions:
    """The multibyte characters of a text: their byte places and the excess bytes up to and with each."""

    def __init__(self, codes: np.ndarray):
        self.at = np.flatnonzero(codes >= 0xC0)
        self.excess = np.concatenate([[0], np.cumsum(_EXCESS[codes[self.at]], dtype=np.int64)])

    def chars(self, place: int) -> int:
        """Code points before a byte place that is no character's inside."""
        return place - int(self.excess[np.searchsorted(self.at, place)])

    def bytes(self, char: int) -> int:
        """The byte place of a code point."""
        # the k-th exception's code point is its place less the excess before it
        before = np.searchsorted(self.at - self.excess[:-1], char)
        return char + int(self.excess[before])


def unit_starts(codes: np.ndarray) -> np.ndarray:
    """Byte places at which units start."""
    letter = _LETTER[codes]
    start = (codes & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


@dataclass(frozen=True)
class Rates:
    """Percent of the texts that are transformed, and of those the percent with the suffix first."""

    moved: int = 90
    suffix_first: int = 20


@dataclass(frozen=True)
class Moved:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def numbers(seed: int, id: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def move_middle(text: bytes, draws: list[int], rates: Rates = Rates()) -> Moved:
    codes = np.frombuffer(text, np.uint8)
    starts = unit_starts(codes) if len(codes) else np.empty(0, np.int64)
    n = len(starts)
    if not text or draws[2] % 100 >= rates.moved or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return Moved(n, "plain", None, None, text)
    cuts = sorted(draw % (n + 1) for draw in draws[:2])
    a, b = (int(starts[u]) if u < n else len(text) for u in cuts)
    index = Exceptions(codes)
    sizes = index.chars(a), index.chars(b) - index.chars(a)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < rates.suffix_first:
        return Moved(n, "spm", *sizes, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)))
    return Moved(n, "psm", *sizes, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 1, rates: Rates = Rates()
) -> DataFrame:
    """id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and output of every row; no shuffle."""
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, BLOCK_TEXTS):
                batch = whole.slice(first, BLOCK_TEXTS)
                digits, texts = batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
                made = [move_middle(t or b"", numbers(seed, d), rates) for d, t in zip(digits, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([m.n for m in made], pa.int64()),
                        pa.array([m.form for m in made], pa.string()),
                        pa.array([m.prefix_chars for m in made], pa.int64()),
                        pa.array([m.middle_chars for m in made], pa.int64()),
                        pa.array([m.output for m in made], pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col(id).alias("id"), F.col(id).cast("string").alias("digits"), F.col(text).alias("text"))
    schema = f"id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id)


def restored(output: Column, form: Column) -> Column:
    """The text from output and form alone. No sentinel can arise across a cut, as none can overlap another one."""
    at = {s: F.instr(output, s.decode()) for s in (PREFIX, SUFFIX, MIDDLE)}

    def between(after: bytes, before: bytes | None) -> Column:
        begin = at[after] + len(after)
        return F.substr(output, begin, (F.length(output) + 1 if before is None else at[before]) - begin)

    middle = between(MIDDLE, None)
    return (
        F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )


SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
         ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM units),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
              ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_middle", SQL)
def op13(spark, sf_dir):
    made = fill_in_middle(documents(spark, sf_dir))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
