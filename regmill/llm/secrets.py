"""Secrets: pattern candidates in every text, weighed by who else in the corpus holds the same value.

Base kinds (assign, access, hex) are regular expressions; their spans always stay. Wider candidates (long
mixed tokens, kind `live`) become spans only if the corpus says so: candidate values are hashed and counted over distinct owners
and repositories, and a value that few owners and few repositories hold and that looks random counts as live, while
one that is copied across many of either is an example. Without a column of repositories each document is one.
Words and dates keep to one kind of character for long; a value looks random if it changes between letters and digits,
or from small letters to capitals, once in `RUN` letters and digits or more often.

Everything is DataFrame functions. Positions come from the lengths of the pieces between matches, in code
points. Frequencies are combinable aggregates of (value, owner) pairs, so a value that a third of all
documents hold is reduced before it is shuffled, and comes back to its spans by a bounded broadcast; texts never move.

A null text is empty and has no spans; a null owner is an owner of its own; equal rows get equal results, and
an empty table an empty one. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.llm.registry import documents, let, query
from regmill.session import written

# The patterns of the base kinds and the least length of what must be long enough.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs are maximal, so a bound inside the pattern equals one on what it matched.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Wider candidates; they also need a letter and three digits, and to look random.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
CHANGE = r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])"
RUN = 6
BLOCK = 64  # matches of a text whose positions are summed together
HEAVY = 1024


def before(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each element of an array of int, all earlier ones merged, starting from `zero`.

    Arrays grow by copying, so a list grown over all elements costs the square of their number: the elements are
    cut into blocks, one list is grown over the blocks and one inside each.
    """

    def scan(items: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("found"))
        return F.aggregate(
            items,
            state,
            lambda s, x: F.struct(merge(s["at"], x).alias("at"), F.concat(s["found"], F.array(s["at"])).alias("found")),
            lambda s: s["found"],
        )

    def over(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(v, k * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(v) > 0, let(blocks, joined)).otherwise(F.array().cast("array<int>"))

    def joined(blocks: Column) -> Column:
        starts = scan(F.transform(blocks, lambda block: F.aggregate(block, zero, lambda a, b: merge(a, b))), zero)
        return F.flatten(F.zip_with(blocks, starts, scan))

    return let(values, over)


def spans(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Array of (at, kind, end, value): the non-overlapping matches, leftmost first, whose group is long enough."""

    def build(x: Column) -> Column:
        sizes = F.transform(
            x["whole"],
            lambda m, i: F.struct(F.length(F.get(x["gaps"], i)).alias("gap"), F.length(m).alias("size")),
        )
        return let(sizes, lambda s: let(before(F.transform(s, _width), F.lit(0), _sum), lambda at: placed(x, s, at)))

    def placed(x: Column, sizes: Column, at: Column) -> Column:
        def one(size: Column, i: Column) -> Column:
            begin = F.get(at, i) + size["gap"]
            return F.struct(
                begin.alias("at"),
                F.lit(KINDS.index(kind)).alias("kind"),
                (begin + size["size"]).alias("end"),
                F.get(x["parts"], i).alias("value"),
            )

        return F.filter(F.transform(sizes, one), lambda s: F.length(s["value"]) >= least)

    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("parts"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    none = F.array().cast("array<struct<at:int,kind:int,end:int,value:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), let(pieces, build)).otherwise(none)


def _width(size: Column) -> Column:
    return size["gap"] + size["size"]


def _sum(a: Column, b: Column) -> Column:
    return a + b


KINDS = ["assign", "access", "hex", "live"]


def looks_random(value: Column) -> Column:
    plain = F.regexp_replace(value, "[^A-Za-z0-9]", "")
    return F.regexp_count(plain, F.lit(CHANGE)) * RUN >= F.length(plain)


def candidates(text: Column) -> Column:
    """Base spans and wider candidates by start, then kind; `clear` is false for candidates that overlap a base span."""
    whole = F.coalesce(text, F.lit(""))
    base = [
        spans(whole, ASSIGN, 2, LEAST["assign"], "assign"),
        spans(whole, ACCESS, 0, LEAST["access"], "access"),
        spans(whole, HEX, 0, LEAST["hex"], "hex"),
    ]
    wide = F.filter(
        spans(whole, TOKEN, 0, 20, "live"),
        lambda s: F.rlike(s["value"], F.lit("[0-9].*[0-9].*[0-9]"))
        & F.rlike(s["value"], F.lit("[A-Za-z]"))
        & looks_random(s["value"]),
    )
    live, none = KINDS.index("live"), F.lit(2**31 - 1)

    def marked(found: Column) -> Column:
        # by start, base kinds first: how far the base spans before one reach, and where the next one starts
        ends = F.transform(found, lambda s: F.when(s["kind"] == live, F.lit(0)).otherwise(s["end"]))
        starts = F.transform(F.reverse(found), lambda s: F.when(s["kind"] == live, none).otherwise(s["at"]))
        around = F.struct(
            before(ends, F.lit(0), F.greatest).alias("reach"), F.reverse(before(starts, none, F.least)).alias("next")
        )

        def mark(x: Column) -> Column:
            return F.transform(
                found,
                lambda s, i: s.withField(
                    "clear", (s["kind"] != live) | ((F.get(x["reach"], i) <= s["at"]) & (F.get(x["next"], i) >= s["end"]))
                ),
            )

        return let(around, mark)

    return let(F.array_sort(F.concat(*base, wide)), marked)


def _listed(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"], s["end"])), ","
    )


def scan_secrets(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str | None = None,
    few_owners: int = 2,
    few_repositories: int = 5,
) -> DataFrame:
    """One row per input row: id, base and all spans (at, kind, end, value, n_owners, n_repositories, live, clear).

    A value is live when at most `few_owners` distinct owners and at most `few_repositories` distinct repositories
    hold it, and copied otherwise. A wider candidate is a span if it is live and does not overlap a base span.
    """
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).alias("id"),
            F.col(owner).cast("string").alias("owner"),
            F.col(repository if repository else id).cast("string").alias("repository"),
            candidates(F.col(text)).alias("spans"),
        ),
        "candidates",
    )
    single = rows.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("s"))
    single = single.withColumn("hash", F.sha2(F.col("s.value").cast("binary"), 256))
    owners = single.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    owners = owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_spans"))
    repositories = (
        single.groupBy("hash", "repository").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("n_repositories"))
    )
    held = written(owners.join(repositories, "hash"), "values")
    # values that more than one in HEAVY spans hold are fewer than HEAVY: they are broadcast, their spans stay where they are
    total = held.agg(F.sum("n_spans")).first()[0] or 0
    heavy = F.broadcast(held.where(F.col("n_spans") * HEAVY > total))
    rest = single.join(heavy, "hash", "left_anti").join(held.where(F.col("n_spans") * HEAVY <= total), "hash")
    weighed = single.join(heavy, "hash").unionByName(rest).groupBy("row").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "s.at",
                    "s.kind",
                    "s.end",
                    "s.value",
                    "n_owners",
                    "n_repositories",
                    ((F.col("n_owners") <= few_owners) & (F.col("n_repositories") <= few_repositories)).alias("live"),
                    "s.clear",
                )
            )
        ).alias("all")
    )
    live_kind = KINDS.index("live")
    none = F.array().cast(weighed.schema["all"].dataType)
    base = F.transform(
        F.filter("spans", lambda s: s["kind"] != live_kind), lambda s: F.struct(s["at"], s["kind"], s["end"], s["value"])
    )
    stays = F.filter("all", lambda s: (s["kind"] != live_kind) | (s["live"] & s["clear"]))
    return (
        rows.join(weighed, "row", "left")
        .select("id", base.alias("base"), F.coalesce("all", none).alias("all"))
        .select(F.col("id").alias(id), "base", stays.alias("found"))
    )


@query("op10_secret_scan")
def op10(spark, sf_dir):
    found = scan_secrets(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_copied"),
    )
