"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Signals are computed per row from the whole text with array functions. Each rule maps them to a vote:
1 (good), -1 (bad) or 0 (abstains). The votes of all rows are counted by vote pattern, at most 3^rules
patterns whatever the input, and expectation-maximisation over the patterns estimates the share of good
documents, and for each rule how often it votes right on good and on bad ones. The posterior probability
of a row's pattern is its quality. Everything is DataFrame functions; the driver sees one row of parameters.

A null text has no words. Texts without words, or failing the base checks, are never kept. Rows are judged one
by one, so repeated rows get equal verdicts. An empty table gives an empty result and the starting
parameters. Parameters are fitted on the rows that pass the base checks, the only ones they decide. Added columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.llm.registry import SPACES, documents, let, query
from regmill.session import written

SYMBOLS = "#*$%&|<>"
ROUNDS = 30
START_GOOD, START_RIGHT, PSEUDO = 0.9, 0.8, 10.0


def signals(text: Column) -> Column:
    """Struct of the signals of a text.

    Windows of three words are compared by a 64-bit hash within the document; equal hashes are adjacent
    after sorting with their place, and the places they cover are counted by their gaps.
    """
    whole = F.coalesce(text, F.lit(""))
    flat = F.translate(whole, SPACES, " " * len(SPACES))

    def repeated(words: Column) -> Column:
        # the place counts from the first window; sorted by hash, then place
        windows = F.when(
            F.size(words) >= 3,
            F.array_sort(
                F.transform(
                    F.arrays_zip(
                        words.alias("a"),
                        F.slice(words, 2, F.size(words)).alias("b"),
                        F.slice(words, 3, F.size(words)).alias("c"),
                    ),
                    lambda w, i: F.struct(
                        F.when(w["c"].isNotNull(), F.xxhash64(w["a"], w["b"], w["c"])).alias("h"), i.alias("i")
                    ),
                )
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

        def places(s: Column) -> Column:
            same = lambda x, j, d: (j + d >= 0) & (j + d < F.size(s)) & (F.get(s, j + d)["h"] == x["h"])
            marked = F.transform(s, lambda x, j: F.when(same(x, j, -1) | same(x, j, 1), x["i"]))
            return F.array_sort(F.filter(marked, lambda p: p.isNotNull()))

        covered = let(
            let(windows, places),
            lambda p: F.aggregate(
                F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(3)), F.lit(3))),
                F.lit(0).cast("long"),
                lambda total, gap: total + gap,
            ),
        )
        return F.struct(F.size(words).cast("long").alias("n_words"), covered.alias("n_repeat_words"))

    words = let(F.filter(F.split(flat, " "), lambda w: w != ""), repeated)
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    solid = F.length(F.translate(whole, SPACES, "")).cast("long")
    marks = (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long")
    runs = (F.size(F.split(whole, "[" + SYMBOLS + "]+")) - 1).cast("long")
    letters = F.length(F.regexp_replace(whole, r"[^\p{L}]+", "")).cast("long")
    return let(
        F.struct(
            words.alias("w"),
            line_counts.alias("l"),
            solid.alias("s"),
            marks.alias("m"),
            runs.alias("r"),
            letters.alias("a"),
        ),
        lambda x: F.struct(
            x["w"]["n_words"].alias("n_words"),
            x["s"].alias("word_chars"),
            x["m"].alias("n_symbols"),
            x["l"]["n_dup_lines"].alias("n_dup_lines"),
            x["w"]["n_repeat_words"].alias("n_repeat_words"),
            x["l"]["n_lines"].alias("n_lines"),
            x["r"].alias("n_symbol_runs"),
            x["a"].alias("n_letters"),
        ),
    )


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(s: Column) -> Column:
    """The rules' votes as an array; every threshold is a share of the text's own size."""
    words, chars = s["n_words"], F.greatest(s["word_chars"], F.lit(1))
    return F.array(
        vote(words >= 80, words < 50),
        vote(20 * s["n_symbols"] <= words, 5 * s["n_symbols"] >= words),
        vote(10 * s["n_dup_lines"] <= s["n_lines"], 10 * s["n_dup_lines"] >= 3 * s["n_lines"]),
        vote(100 * s["n_repeat_words"] <= 15 * words, 100 * s["n_repeat_words"] >= 40 * words),
        vote((chars >= 3 * words) & (chars <= 12 * words), (2 * chars < 5 * words) | (chars > 20 * words)),
        vote(100 * s["n_letters"] >= 92 * chars, 100 * s["n_letters"] <= 88 * chars),
        vote(20 * s["n_symbol_runs"] <= words, 10 * s["n_symbol_runs"] >= words),
    )


RULES = 7


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


@dataclass(frozen=True)
class Model:
    """Share of good documents; per rule the probability of a good vote, given that it votes,
    on good and on bad documents."""

    good: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]


def _posterior(v: Column, good: Column, on_good: Column, on_bad: Column) -> Column:
    def odds(rates: Column) -> Column:
        parts = F.transform(
            v, lambda x, i: F.when(x == 1, F.get(rates, i)).when(x == -1, 1 - F.get(rates, i)).otherwise(1.0)
        )
        return F.aggregate(parts, F.lit(1.0), lambda total, p: total * p)

    a, b = good * odds(on_good), (1 - good) * odds(on_bad)
    return a / (a + b)


def fit(voted: DataFrame, column: str = "votes", rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over the counted vote patterns, as one fold over one row.

    The starting rates count as `PSEUDO` votes of each kind, so a rule that always abstains keeps them and the meaning
    of good cannot flip.
    """
    patterns = voted.groupBy(F.col(column).alias("v")).agg(F.count("*").cast("double").alias("n"))
    # empty patterns are rows that do not count; dropped here, where no filter on the votes' inputs can come of it
    counted = F.filter(F.sort_array(F.collect_list(F.struct("v", "n"))), lambda p: F.size(p["v"]) > 0)
    row = patterns.agg(counted.alias("patterns"))

    def step(state: Column) -> Column:
        weighed = F.transform(
            "patterns",
            lambda p: let(
                _posterior(p["v"], state["good"], state["on_good"], state["on_bad"]),
                lambda q: F.struct(p["v"].alias("v"), (p["n"] * q).alias("g"), (p["n"] * (1 - q)).alias("b")),
            ),
        )

        def total(w: Column, part: str, i: int | None = None, kind: str = "") -> Column:
            counts = F.transform(
                w,
                lambda p: p[part]
                if i is None
                else F.when(F.get(p["v"], F.lit(i)) == 1 if kind == "up" else F.get(p["v"], F.lit(i)) != 0, p[part])
                .otherwise(0.0),
            )
            return F.aggregate(counts, F.lit(0.0), lambda x, y: x + y)

        def rate(w: Column, part: str, i: int, start: float) -> Column:
            return (total(w, part, i, "up") + PSEUDO * start) / (total(w, part, i, "any") + PSEUDO)

        return let(
            weighed,
            lambda w: F.struct(
                ((total(w, "g") + PSEUDO * START_GOOD) / (total(w, "g") + total(w, "b") + PSEUDO)).alias("good"),
                F.array(*[rate(w, "g", i, START_RIGHT) for i in range(RULES)]).alias("on_good"),
                F.array(*[rate(w, "b", i, 1 - START_RIGHT) for i in range(RULES)]).alias("on_bad"),
            ),
        )

    start = F.struct(
        F.lit(START_GOOD).alias("good"),
        F.array(*[F.lit(START_RIGHT)] * RULES).alias("on_good"),
        F.array(*[F.lit(1 - START_RIGHT)] * RULES).alias("on_bad"),
    )
    fold = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda state, _: step(state))
    found = row.select(fold.alias("m")).first()["m"]
    return Model(found["good"], tuple(found["on_good"]), tuple(found["on_bad"]))


def quality(v: Column, model: Model) -> Column:
    """Posterior probability that a row with these votes is good."""
    return _posterior(
        v,
        F.lit(model.good),
        F.array(*[F.lit(x) for x in model.on_good]),
        F.array(*[F.lit(x) for x in model.on_bad]),
    )


def keep_good(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows that pass the base checks and whose posterior quality is at least `least`.

    Texts are read once: rows are written with their votes (none if they fail a base check), to which the model is
    fitted and which it then decides.
    """
    signs = docs.select(F.struct(*docs.columns).alias("doc"), signals(F.col(text)).alias("s"))
    none = F.array().cast("array<int>")
    # the votes are a value of their own, so that filters on them do not compute the signals again
    voted = signs.select("doc", let(F.col("s"), lambda s: F.when(base_failed(s), none).otherwise(votes(s))).alias("votes"))
    rows = written(voted, "votes")
    model = fit(rows.select("votes"))
    return rows.where((F.size("votes") > 0) & (quality(F.col("votes"), model) >= least)).select("doc.*")


def judge(docs: DataFrame, id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """id, the signals, base_failed, votes, quality and kept of every row; texts are read once."""
    rows = written(docs.select(F.col(id).alias(id), signals(F.col(text)).alias("s")), "signals")
    rows = rows.withColumn("votes", votes(F.col("s")))
    failed = base_failed(F.col("s"))
    model = fit(rows.where(~failed))
    p = quality(F.col("votes"), model)
    return rows.select(
        id, "s.*", failed.alias("base_failed"), "votes", p.alias("quality"), (~failed & (p >= least)).alias("kept")
    )


@query("op1_quality_rules")
def op1(spark, sf_dir):
    return judge(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "quality",
    )
