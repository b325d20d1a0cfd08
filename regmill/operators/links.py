"""Choosing, routing, following and naming links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.functions import urls as U
from regmill.operators import bloom
from regmill.operators.extract import extract_links
from regmill.operators.scale import first_by


def keep_links(
    links: DataFrame, endings: list[str] | None = None, beginnings: list[str] | None = None, href: str = "href"
) -> DataFrame:
    """Links with one of the endings and one of the beginnings (case matters; an empty list allows all)."""
    c = F.col(href)
    if endings:
        links = links.where(U.any_of([F.endswith(c, F.lit(e)) for e in endings]))
    if beginnings:
        links = links.where(U.any_of([F.startswith(c, F.lit(b)) for b in beginnings]))
    return links


def one_of(href: Column, endings: Column | None = None, beginnings: Column | None = None) -> Column:
    """The same with lists held in columns, as rules give them."""
    ok = F.lit(True)
    if endings is not None:
        ok = ok & (F.exists(endings, lambda e: F.endswith(href, e)) | (F.size(endings) == 0))
    if beginnings is not None:
        ok = ok & (F.exists(beginnings, lambda b: F.startswith(href, b)) | (F.size(beginnings) == 0))
    return ok


def keep_by_rules(links: DataFrame, rules: DataFrame, href: str = "href") -> DataFrame:
    """Links that the endings and beginnings of their site allow."""
    joined = links.join(rules.select("site", "endings", "beginnings"), "site")
    kept = joined.where(one_of(F.col(href), F.col("endings"), F.col("beginnings")))
    return kept.drop("endings", "beginnings")


def padded_release(links: DataFrame, prefix: str, href: str = "href") -> DataFrame:
    """Targets padded with blanks in the markup: kept when they begin with the padded prefix, then the first word."""
    word = F.try_element_at(F.split(F.trim(F.col(href)), r"\s+"), F.lit(1))
    return links.where(F.startswith(F.col(href), F.lit(prefix))).withColumn(href, word)


def deny_links(links: DataFrame, denied: DataFrame, by: list[str], href: str = "href") -> DataFrame:
    """Links that are not on the list; `denied` holds the same columns, a null in it denies nothing."""
    return links.join(denied.select(*by, F.col("value").alias(href)), [*by, href], "left_anti")


def deny_endings(links: DataFrame, endings: list[str], href: str = "href") -> DataFrame:
    return links.where(~U.any_of([F.endswith(F.col(href), F.lit(e)) for e in endings]))


def route_links(links: DataFrame, root: Column | str, page_prefix: Column | str, href: str = "href") -> DataFrame:
    """How a target is taken: page turned to text, text file, PDF on site or PDF elsewhere; others drop out."""
    c = F.col(href)
    root = F.lit(root) if isinstance(root, str) else root
    prefix = F.lit(page_prefix) if isinstance(page_prefix, str) else page_prefix
    pdf = F.endswith(c, F.lit(".pdf"))
    route = (
        F.when(F.endswith(c, F.lit(".htm")) & F.startswith(c, prefix), "page_text")
        .when(F.endswith(c, F.lit(".txt")), "text_file")
        .when(pdf & F.startswith(c, root), "pdf_absolute")
        .when(pdf, "pdf_relative")
    )
    return links.withColumn("route", route).where(F.col("route").isNotNull())


def resolve_links(links: DataFrame, base: Column, href: str = "href", into: str = "target") -> DataFrame:
    return links.withColumn(into, U.resolve(base, F.col(href)))


def name_targets(links: DataFrame, rule: Column | str, target: str = "target", into: str = "file_name") -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return links.withColumn(into, U.file_name(F.col(target), rule))


def filings_between(
    df: DataFrame, after: str, before: str, filed: str = "filed", inclusive: bool = False
) -> DataFrame:
    """Filings strictly inside the window; plain comparisons, so they reach the file scan."""
    c, lo, hi = F.col(filed), F.lit(after).cast("date"), F.lit(before).cast("date")
    return df.where((c >= lo) & (c <= hi)) if inclusive else df.where((c > lo) & (c < hi))


def follow(links: DataFrame, pages: DataFrame, order: list[str], target: str = "target") -> DataFrame:
    """Document links found on the pages that listing links point to.

    Listing links are reduced to one row per target (first place and number of references), so
    a page that everything points to is matched once, and pages to their links, so that the
    join moves links and not markup.
    """
    refs = links.groupBy(target).agg(F.min(F.struct(*order)).alias("first_ref"), F.count("*").alias("n_refs"))
    found = extract_links(pages.select(F.col("url").alias(target), "html"))
    return refs.join(found, target)


def unmatched(links: DataFrame, pages: DataFrame, target: str = "target") -> DataFrame:
    """Followed targets that have no page."""
    wanted = links.groupBy(target).agg(F.count("*").alias("n_refs"))
    return wanted.join(pages.select(F.col("url").alias(target)), target, "left_anti")


def not_held(targets: DataFrame, manifest: DataFrame, place: list[str], order: list[str]) -> DataFrame:
    """Targets still to fetch: the first of each place in this batch, unless it is held already.

    Parts of a place may be null (no category, no folder per year); nulls are equal here.
    """
    fresh = first_by(targets, place, [F.col(c) for c in order])
    held = manifest.select(*[F.col(c).alias(f"_held_{c}") for c in place]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in place]
    return fresh.join(held, reduce(lambda a, b: a & b, same), "left_anti")


def not_held_filtered(
    targets: DataFrame, manifest: DataFrame, place: list[str], order: list[str], max_bytes: int = bloom.MAX_BYTES
) -> DataFrame:
    """The rows of `not_held`, for a manifest far larger than the batch.

    A Bloom filter of the manifest tells most new targets at once. Only possible hits are compared with the manifest, and
    of the manifest only rows that equal one of them: Spark broadcasts the hits while they are few, so the manifest
    itself is not shuffled. A manifest whose filter would be above `max_bytes`, or whose places have other
    types than the targets', is compared as in `not_held`.
    """
    keys = manifest.count()
    same_types = all(targets.schema[c].dataType == manifest.schema[c].dataType for c in place)
    if not same_types or bloom.filter_bytes(keys) > max_bytes:
        return not_held(targets, manifest, place, order)
    blocks = bloom.block_count(keys)
    fresh = first_by(targets, place, [F.col(c) for c in order])
    marked = bloom.look_up(fresh, place, bloom.build(manifest, place, blocks), blocks, "_maybe")
    hits = marked.where("_maybe").drop("_maybe")
    held = manifest.select(*[F.col(c).alias(f"_held_{c}") for c in place])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in place])
    asked = held.join(hits.select(*place), same, "left_semi").distinct()
    return marked.where(~F.col("_maybe")).drop("_maybe").unionByName(hits.join(asked, same, "left_anti"))


def classify(df: DataFrame, n_files: str = "n_files", failed: str = "failed") -> DataFrame:
    outcome = (
        F.when(F.col(failed), "error").when(F.col(n_files) == 0, "no files").otherwise("files")
    )
    return df.withColumn("outcome", outcome)


def held_or_new(targets: DataFrame, manifest: DataFrame, place: list[str]) -> DataFrame:
    """Each target marked downloaded or already held; nulls in a place are equal."""
    names = [f"_held_{c}" for c in place]
    held = manifest.select(*[F.col(c).alias(n) for c, n in zip(place, names)]).distinct().withColumn("_held", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(place, names)])
    out = targets.join(held, same, "left")
    outcome = F.when(F.col("_held"), "already held").otherwise("downloaded")
    return out.withColumn("outcome", outcome).drop("_held", *names)
