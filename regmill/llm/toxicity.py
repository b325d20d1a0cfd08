"""Toxicity by a weighted lexicon of word stems, matched by Aho-Corasick in folded text.

Folding: lower case; letters with marks and look-alike letters of other scripts become plain Latin
ones; digits and signs that stand for letters inside a word become those letters; invisible
characters go; everything else but letters becomes a space. An entry matches at the start of a word.
Exception phrases are entries too: a stem inside a longer matched exception does not count.

The lexicon is learned: in a bounded sample of labelled documents every prefix of every word is counted
in toxic and other documents. Stems are kept that occur far more often in toxic ones (by ratio and by a likelihood-ratio test);
the weight is the logarithm of that ratio. Equal texts count once. Two-word phrases around a kept stem that only other documents hold become exceptions.
The score is a logistic function of the matched weight in all, and of the matched weight per word.

A null or empty text scores as one without a match. Labels that are null are not learned from. A text
is scored whole. Repeated rows get equal scores; an empty table gives an empty result, and without
labelled rows of both kinds the lexicon is empty and the scores are the base rate's.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.llm.registry import documents, query

SAMPLE = 12_000
STEM = (3, 12)  # letters of a stem
LEAST_DOCS = 5
LEAST_RATIO = 20.0
LEAST_SURPLUS = 35.0  # likelihood-ratio statistic, twice the log-likelihood
PHRASE_DOCS = 5

# Look-alikes of Latin letters in Cyrillic and Greek, and what stands for letters.
LOOK_ALIKES = dict(
    zip(
        "авекмнорстухіјѕԁһցԛԝαβγεηικνορτυχω",
        "abekmhopctyxijsdhgqwabyenikvoptuxw",
        strict=True,
    )
)
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "­​‌‍⁠﻿"


class Folding(dict):
    """Translation table that fills itself: one entry for each character met."""

    def __missing__(self, code: int):
        char = chr(code)
        if char in INVISIBLE:
            value = ""
        else:
            plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower()
            plain = "".join(LOOK_ALIKES.get(c, c) for c in plain)
            value = "".join(c if c.isalpha() or c in STANDS_FOR else " " for c in plain)
        self[code] = value
        return value


class Fold:
    def __init__(self):
        self.folding, self.stands_for = Folding(), str.maketrans(STANDS_FOR)

    def __call__(self, text: str | None) -> str:
        """Folded text, a space before and after each word. Words without a letter stay as they are."""
        plain = (text or "").lower().translate(self.folding)
        if not any(c in plain for c in STANDS_FOR):
            return " " + " ".join(plain.split()) + " "
        words = []
        for word in plain.split():
            if not word.isalpha():
                # signs at the end of a word are punctuation, not letters
                word = word.rstrip("!$@")
                if any(c.isalpha() for c in word):
                    word = word.translate(self.stands_for)
            words.append(word)
        return " " + " ".join(words) + " "


@dataclass(frozen=True)
class Lexicon:
    """Stems with weights, exception phrases, and the logistic function's bias and two factors."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.fold = Fold()
        self.machine = ahocorasick.Automaton()
        for stem, weight in lexicon.weights.items():
            self.machine.add_word(" " + stem, (len(stem), weight, False))
        for phrase in lexicon.exceptions:
            self.machine.add_word(" " + phrase, (len(phrase), 0.0, True))
        self.empty = not len(self.machine)
        if not self.empty:
            self.machine.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the matches that no exception covers; of nested ones the heaviest."""
        if self.empty:
            return []
        best: dict[int, tuple[int, int, float]] = {}
        excused: list[tuple[int, int]] = []
        for last, (size, weight, exception) in self.machine.iter(folded):
            start, end = last + 1 - size, last + 1
            if exception:
                if not folded[end : end + 1].isalpha():
                    excused.append((start, end))
            elif start not in best or weight > best[start][2]:
                best[start] = (start, end, weight)
        if excused:
            return [m for m in best.values() if not any(a <= m[0] and m[1] <= b for a, b in excused)]
        return list(best.values())

    def features(self, text: str | None) -> tuple[float, float]:
        """Logarithm of one plus the matched weight, and matched weight per word."""
        folded = self.fold(text)
        total = sum(weight for _, _, weight in self.matches(folded))
        return math.log1p(total), total / max(folded.count(" ") - 1, 1)


def _score(curve: tuple[float, float, float], total: float, rate: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, curve[0] + curve[1] * total + curve[2] * rate))))


def _curve(x: np.ndarray, y: np.ndarray, rounds: int = 30, penalty: float = 1.0) -> tuple[float, float, float]:
    """Penalised logistic regression by Newton steps; the factors are kept from being negative."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = p * (1 - p) + 1e-6
        shrink = np.diag([1e-6, penalty, penalty])
        step = np.linalg.solve(x.T @ (x * w[:, None]) + shrink, x.T @ (y - p) - shrink @ beta)
        beta = beta + np.clip(step, -2, 2)
    return float(beta[0]), max(0.0, float(beta[1])), max(0.0, float(beta[2]))


def training_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, where: str, rows: int) -> DataFrame:
    """text and label of at most `rows` labelled documents, those of the least hash of the id.

    Where labels of an id, or of equal texts, disagree, the more frequent one holds; on a tie the document is not toxic.
    """
    toxic = (2 * F.sum((F.col("_label") == 1).cast("int")) > F.count("*")).cast("int").alias("_label")
    wanted = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label")).where("_label is not null")
    wanted = wanted.where(F.expr(where.format(id="_id"))).groupBy("_id").agg(toxic)
    wanted = wanted.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return (
        docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(wanted), "_id")
        .withColumn("_digest", F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256))
        .groupBy("_digest")
        .agg(F.max("_text").alias("_text"), toxic)
        .select("_text", "_label")
    )


def learn(sample: DataFrame) -> Lexicon:
    """Lexicon from `_text` and `_label` (1: toxic). Counting runs on the executors, the driver gets the entries."""

    def count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other, n, fold = Counter(), Counter(), [0, 0], Fold()
        for batch in batches:
            for text, label in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                words = set(fold(text).split())
                stems = {w[:k] for w in words if w.isalpha() for k in range(STEM[0], min(len(w), STEM[1]) + 1)}
                (toxic if label == 1 else other).update(stems)
                n[label == 1] += 1
        keys = [""] + list(toxic.keys() | other.keys())
        toxic[""], other[""] = n[1], n[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array([toxic[k] for k in keys]), pa.array([other[k] for k in keys])],
            ["stem", "toxic", "other"],
        )

    counted = sample.mapInArrow(count_stems, "stem string, toxic bigint, other bigint")
    counted = counted.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    whole = sample.agg(
        F.sum((F.col("_label") == 1).cast("long")).alias("t"), F.sum((F.col("_label") != 1).cast("long")).alias("o")
    ).first()
    n_toxic, n_other = whole["t"] or 0, whole["o"] or 0
    if not n_toxic or not n_other:
        base = math.log((n_toxic + 0.5) / (n_other + 0.5)) if n_toxic + n_other else -4.0
        return Lexicon(curve=(min(base, -1.0), 0.0, 0.0))
    toxic, other = F.col("toxic") + 0.5, F.col("other") + 0.5
    weight = F.log(toxic / (n_toxic + 1.0)) - F.log(other / (n_other + 1.0))
    share, both = n_toxic / (n_toxic + n_other), F.col("toxic") + F.col("other")
    surplus = 2 * (
        F.col("toxic") * F.log(F.col("toxic") / (both * share))
        + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") / (both * (1 - share)))).otherwise(0.0)
    )
    kept = counted.where(f"stem != '' and toxic >= {LEAST_DOCS}").withColumn("weight", weight)
    kept = kept.where((F.col("weight") >= math.log(LEAST_RATIO)) & (surplus >= LEAST_SURPLUS))
    found = kept.collect()
    # a stem gives way to a continuation that nearly all its toxic documents hold; what remains stands for its
    # continuations unless one of them tells clearly more
    longer: dict[str, int] = {}
    for row in found:
        longer[row["stem"][:-1]] = max(longer.get(row["stem"][:-1], 0), row["toxic"])
    found = [r for r in found if longer.get(r["stem"], 0) < 0.9 * r["toxic"]]
    weights: dict[str, float] = {}
    for row in sorted(found, key=lambda r: (len(r["stem"]), r["stem"])):
        stem, weight = row["stem"], row["weight"]
        shorter = max((weights[stem[:k]] for k in range(STEM[0], len(stem)) if stem[:k] in weights), default=None)
        if shorter is None or weight > shorter + 1.0:
            weights[stem] = weight
    first = Lexicon(weights)

    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other, stems = Counter(), Counter(), Matcher(first)
        for batch in batches:
            for text, label in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                folded, phrases = stems.fold(text), set()
                for start, _, _ in stems.matches(folded):
                    end = folded.find(" ", start)
                    after, before = folded.find(" ", end + 1), folded.rfind(" ", 0, start - 1) + 1
                    phrases.add(folded[before:end])
                    phrases.add(folded[start : after if after > 0 else end])
                (toxic if label == 1 else other).update(p.strip() for p in phrases if " " in p.strip())
        keys = list(other)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()), pa.array([other[k] for k in keys], pa.int64())],
            ["phrase", "toxic", "other"],
        )

    phrases = sample.mapInArrow(count_phrases, "phrase string, toxic bigint, other bigint").groupBy("phrase")
    phrases = phrases.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    phrases = phrases.where(f"toxic = 0 and other >= {PHRASE_DOCS}")
    exceptions = tuple(sorted(r["phrase"] for r in phrases.collect()))
    lexicon = Lexicon(weights, exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            both = [matcher.features(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in both], pa.float64()), pa.array([b for _, b in both], pa.float64()), batch.column("_label")],
                ["total", "rate", "label"],
            )

    points = sample.mapInArrow(measure, "total double, rate double, label int").collect()  # at most SAMPLE rows
    x = np.array([[p["total"], p["rate"]] for p in points], float).reshape(-1, 2)
    y = np.array([p["label"] == 1 for p in points], float)
    return Lexicon(weights, exceptions, _curve(x, y))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score of every row; the lexicon is what the bounded sample of labelled rows gives."""
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch in batches:
            scores = [_score(lexicon.curve, *matcher.features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id)


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    remainder = "crc32(cast({id} as string)) % 4"
    sample = training_sample(docs, labels, "doc_id", "text", "toxic", remainder + " != 2", SAMPLE)
    scores = score_toxicity(docs, learn(sample))
    return scores.select(
        "doc_id",
        F.expr(remainder.format(id="doc_id") + " = 2").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
