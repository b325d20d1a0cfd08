"""Language by interpolated Kneser-Ney models of characters, one per language.

Counting covers all learning rows: tasks count four-character keys (16 bits a character, folded
to lower case, runs of non-letters as one space) with sorting and run lengths, and Spark adds them up per language.
The shorter orders follow from the counted keys as continuation counts. The model of a language is three sorted
arrays of keys with the probability of each seen sequence, and the mass that each context leaves to the
next shorter order; look-ups are binary searches. Every counted key of every language is in its model: models grow
with the distinct keys of the learning rows, and so does what is broadcast. The driver takes the counts and
sends the models by shards: languages of some `SHARD` keys together, or one larger language.

A text has the language of least cross-entropy per character. The score is the softmax of the negated
cross-entropies (scaled by the root of the text's length), times the calibrated probability
that the text belongs to any learned language: a logistic function of how far its cross-entropy lies above
what the language's learning texts have (mean and deviation). Below `reject` the text counts as rejected.

A text that is null or has no letter is `und` with score 0, and rejected. Null languages are not learned from. Ties go
to the first language by name. With nothing to learn from every text is `und`. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.llm.registry import documents, query
from regmill.session import written

ORDER = 4
SHARD = 4_000_000
DISCOUNT = 0.75
SLICE_CHARS = 4_000_000


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters of all texts, each text led by ORDER - 1 spaces, and the texts' lengths in them."""
    plain = [(t or "").lower() for t in texts]
    joined = "".join(" " * ORDER + t + " " for t in plain)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) + ORDER + 1 for t in plain])
    kinds, where = np.unique(chars, return_inverse=True)
    letter = np.array([chr(int(k)).isalpha() for k in kinds], bool)
    # letters of the first plane are kept as they are, the others are folded onto it, though never onto the space
    folded = (kinds ^ (kinds >> 16)).astype(np.uint64) & 0xFFFF
    folded[folded == 32] = 0xFFFF
    return np.where(letter, folded, 32).astype(np.uint64)[where], lengths


def _keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Four-character keys of the batch with runs of spaces squeezed; text number of each key; has a letter."""
    codes, lengths = _codes(texts)
    owner = np.repeat(np.arange(len(texts)), lengths)
    first = np.zeros(len(codes), bool)
    starts = np.cumsum(lengths) - lengths
    for k in range(ORDER):
        first[starts + k] = True
    stays = first.copy()
    stays[1:] |= (codes[1:] != 32) | (codes[:-1] != 32)
    codes, owner, first = codes[stays], owner[stays], first[stays]
    key = codes[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        key |= codes[ORDER - 1 - back : len(codes) - back] << np.uint64(16 * back)
    # a key belongs to the text of its last character, and none ends in the leading spaces
    real = ~first[ORDER - 1 :]
    letters = np.bincount(owner[codes != 32], minlength=len(texts)) > 0
    return key[real], owner[ORDER - 1 :][real], letters


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded length together (one text at least)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > begin and size + n > SLICE_CHARS:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def count_keys(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, key, n of all rows; a task holds counts of one slice and of the keys seen so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, pd.Series] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by: dict[str, list] = {}
            for t, name in zip(texts, langs, strict=True):
                by.setdefault(name, []).append(t)
            for name, own in by.items():
                for a, b in _slices(own):
                    keys, counts = np.unique(_keys(own[a:b])[0], return_counts=True)
                    now = pd.Series(counts, index=keys.view(np.int64))
                    seen[name] = seen[name].add(now, fill_value=0) if name in seen else now
        for name, counts in seen.items():
            for a in range(0, len(counts), 50_000):
                part = counts.iloc[a : a + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part)), pa.array(part.index.to_numpy()), pa.array(part.to_numpy().astype("i8"))],
                    ["lang", "key", "n"],
                )

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    counts = rows.mapInArrow(run, "lang string, key bigint, n bigint")
    return counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _found(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, wanted), max(len(sorted_keys) - 1, 0))
    return at, (sorted_keys[at] == wanted) if len(sorted_keys) else np.zeros(len(wanted), bool)


@dataclass
class CharModel:
    """Orders 1 to ORDER: sorted keys with discounted probability, sorted contexts with the mass left over."""

    keys: list[np.ndarray]
    probs: list[np.ndarray]
    contexts: list[np.ndarray]
    left: list[np.ndarray]
    usual: tuple[float, float] = (0.0, 1.0)

    @staticmethod
    def learn(keys: np.ndarray, counts: np.ndarray) -> CharModel:
        """keys sorted, their counts; shorter orders count the distinct characters seen before them."""
        model = CharModel([], [], [], [])
        for order in range(ORDER, 0, -1):
            context = keys >> np.uint64(16)
            names, which, sizes = np.unique(context, return_inverse=True, return_counts=True)
            total = np.bincount(which, counts, len(names))
            model.keys.insert(0, keys)
            model.probs.insert(0, (counts - DISCOUNT).clip(0) / total[which])
            model.contexts.insert(0, names)
            # counts below the discount cannot be: the least is one
            model.left.insert(0, DISCOUNT * sizes / total)
            short = keys & np.uint64((1 << (16 * (order - 1))) - 1)
            keys, counts = np.unique(short, return_counts=True)
            counts = counts.astype(float)
        return model

    def surprise(self, keys: np.ndarray) -> np.ndarray:
        """Bits of the last character of each key after the others."""
        p = np.full(len(keys), 1.0 / 65536)
        for order in range(1, ORDER + 1):
            part = keys & np.uint64((1 << (16 * order)) - 1)
            at, there = _found(self.contexts[order - 1], part >> np.uint64(16))
            mass = np.where(there, self.left[order - 1][at], 1.0)
            at, seen = _found(self.keys[order - 1], part)
            p = mass * p + np.where(seen, self.probs[order - 1][at], 0.0)
        return -np.log2(p)


def entropies(models: dict[str, CharModel], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character [text, language], characters and has-a-letter of each text."""
    out = np.zeros((len(texts), len(models)))
    chars, letters = np.zeros(len(texts)), np.zeros(len(texts), bool)
    for a, b in _slices(texts):
        keys, owner, has = _keys(texts[a:b])
        codes, kinds = pd.factorize(keys)
        n = np.bincount(owner, minlength=b - a)
        chars[a:b], letters[a:b] = n, has
        for k, model in enumerate(models.values()):
            bits = model.surprise(np.asarray(kinds, np.uint64))[codes]
            out[a:b, k] = np.bincount(owner, bits, b - a) / np.maximum(n, 1)
    return out, chars, letters


def _shards(sizes: dict[str, int]) -> Iterator[list[str]]:
    """Names in order, cut into groups of at most SHARD keys together (one name at least)."""
    group, held = [], 0
    for name in sorted(sizes):
        if group and held + sizes[name] > SHARD:
            yield group
            group, held = [], 0
        group.append(name)
        held += sizes[name]
    if group:
        yield group


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, CharModel]:
    """Models by language, in order of name. The counts come from every row of `docs`, and calibration
    measures every row with a letter against its own language's model."""
    counts = written(count_keys(docs, text, lang), "language-keys")
    sizes = {row["lang"]: row["n"] for row in counts.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    models = {}
    for group in _shards(sizes):
        table = counts.where(F.col("lang").isin(group)).toArrow().combine_chunks()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        which = langs.indices.to_numpy()
        keys = table.column("key").to_numpy().view(np.uint64)
        order = np.lexsort((keys, which))
        keys, numbers = keys[order], table.column("n").to_numpy()[order].astype(float)
        edges = np.searchsorted(which[order], np.arange(len(langs.dictionary) + 1))
        for name, a, b in zip(langs.dictionary.to_pylist(), edges[:-1], edges[1:], strict=True):
            models[name] = CharModel.learn(keys[a:b], numbers[a:b])
    models = {name: models[name] for name in sorted(models)}
    _calibrate(docs, models, text, lang)
    return models


def _broadcast(docs: DataFrame, models: dict[str, CharModel]) -> list:
    """The models' arrays, one broadcast a shard."""
    send = docs.sparkSession.sparkContext.broadcast
    sizes = {name: len(m.keys[-1]) for name, m in models.items()}
    return [
        send({n: (models[n].keys, models[n].probs, models[n].contexts, models[n].left, models[n].usual) for n in group})
        for group in _shards(sizes)
    ]


def _received(shared: list) -> dict[str, CharModel]:
    return {name: CharModel(*parts) for shard in shared for name, parts in shard.value.items()}


def _calibrate(docs: DataFrame, models: dict[str, CharModel], text: str, lang: str) -> None:
    if not models:
        return
    shared = _broadcast(docs, models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _received(shared)
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by: dict[str, list] = {}
            for t, name in zip(texts, langs, strict=True):
                by.setdefault(name, []).append(t)
            for name, own in by.items():
                # a language whose rows hold no key has no model
                if name in models:
                    bits, _, letters = entropies({name: models[name]}, own)
                    own_bits = bits[letters, 0]
                    names = pa.array([name] * len(own_bits), pa.string())
                    yield pa.RecordBatch.from_arrays([names, pa.array(own_bits, pa.float64())], ["lang", "bits"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null")
    measured = rows.mapInArrow(run, "lang string, bits double")
    for row in measured.groupBy("lang").agg(F.mean("bits").alias("m"), F.stddev_pop("bits").alias("s")).collect():
        models[row["lang"]].usual = (row["m"], max(row["s"], 0.25))


def identify(docs: DataFrame, models: dict[str, CharModel], id: str = "doc_id", text: str = "text", reject: float = 0.05) -> DataFrame:
    """id, lang_pred, score and rejected of every row."""
    shared = _broadcast(docs, models)
    id_type = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _received(shared)
        names = list(models)
        usual = np.array([m.usual for m in models.values()]).reshape(-1, 2)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            bits, chars, letters = entropies(models, texts)
            if not names:
                letters[:] = False
                best, score = np.zeros(len(texts), int), np.zeros(len(texts))
            else:
                best = bits.argmin(1)
                least = bits.min(1)
                odds = np.exp(-np.minimum((bits - least[:, None]) * np.sqrt(np.maximum(chars, 1))[:, None], 50))
                above = (least - usual[best, 0]) / usual[best, 1]
                known = 1 / (1 + np.exp(np.clip(above - 6.0, -30, 30)))
                score = np.where(letters, known / odds.sum(1), 0.0)
            pred = [names[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64())], ["id", "lang_pred", "score"]
            )

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double")
    return found.select(F.col("id").alias(id), "lang_pred", "score", (F.col("score") < reject).alias("rejected"))


@query("op5_language_id")
def op5(spark, sf_dir):
    docs = documents(spark, sf_dir)
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    models = learn(docs.where(remainder != 1))
    return identify(docs, models).select("doc_id", (remainder == 1).alias("held_out"), "lang_pred", "score", "rejected")
