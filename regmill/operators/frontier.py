"""Addresses to visit, generated by row generators rather than loops or cross joins."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.functions.text import strip


def expand_years(rules: DataFrame, as_of_year: int) -> DataFrame:
    """One row per year of each rule; a last year <= 0 counts from `as_of_year`, an empty range gives none."""
    last = F.when(F.col("year_hi") <= 0, F.col("year_hi") + F.lit(as_of_year)).otherwise(F.col("year_hi"))
    return (
        rules.withColumn("year_hi", last.cast("int"))
        .where(F.col("year_lo") <= F.col("year_hi"))
        .withColumn("year", F.explode(F.sequence("year_lo", "year_hi")))
    )


def apply_year_rules(df: DataFrame, year_rules: DataFrame) -> DataFrame:
    """Attach the rule whose year range holds the row's year; a range without a last year stays open.

    The join is by site, whose rules are a few rows, with the range as predicate. `without_rule` has the rest.
    """
    out = df.join(year_rules, "site").where(_covers()).drop("year_lo", "year_hi")
    return out.withColumn("template", F.replace(F.col("template"), F.lit("{year}"), F.col("year").cast("string")))


def year_scope(df: DataFrame, year_rules: DataFrame) -> DataFrame:
    """`scope` replaced by that of the rule which holds the row's year, also where that is null; other rows keep theirs."""
    rules = year_rules.select(
        F.col("site").alias("_site"), "year_lo", "year_hi", F.struct(F.col("scope").alias("scope")).alias("_rule")
    )
    out = df.join(rules, (F.col("site") == F.col("_site")) & _covers(), "left")
    scope = F.when(F.col("_rule").isNotNull(), F.col("_rule.scope")).otherwise(F.col("scope"))
    return out.withColumn("scope", scope).drop("_site", "year_lo", "year_hi", "_rule")


def without_rule(df: DataFrame, year_rules: DataFrame) -> DataFrame:
    """The rows whose year no rule of their site holds, or whose site has none."""
    rules = year_rules.select(F.col("site").alias("_site"), "year_lo", "year_hi")
    return df.join(rules, (F.col("site") == F.col("_site")) & _covers(), "left_anti")


def _covers() -> Column:
    return (F.col("year") >= F.col("year_lo")) & (F.col("year_hi").isNull() | (F.col("year") <= F.col("year_hi")))


def letters() -> Column:
    return F.transform(F.sequence(F.lit(97), F.lit(122)), lambda c: F.chr(c))


def cross_frontier(df: DataFrame, **dims: Column | list) -> DataFrame:
    """Every combination of a row with the values of literal dimensions."""
    for name, values in dims.items():
        column = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])
        df = df.withColumn(name, F.explode(column))
    return df


def caption_total(caption: Column, lead: str = "of ") -> Column:
    """Total behind `lead` in captions such as '1 to 100 of 1,234 entries'; null when there is none."""
    tail = F.trim(F.substring_index(F.substring_index(caption, " entries", 1), lead, -1))
    return F.replace(tail, F.lit(","), F.lit("")).try_cast("bigint")


def page_count(df: DataFrame, caption: str, size: int, lead: str = "of ") -> DataFrame:
    total = caption_total(F.col(caption), lead)
    return df.withColumn("total", total).withColumn("n_pages", F.ceil(F.col("total") / F.lit(size)))


def last_page(df: DataFrame, column: str, how: str) -> DataFrame:
    """Pages from the last-page link: first or last '=' value plus one, or a number as shown."""
    c = F.col(column)
    value = {
        "first_value": lambda: F.try_element_at(F.split(c, "="), F.lit(2)).try_cast("bigint") + 1,
        "last_value": lambda: F.substring_index(c, "=", -1).try_cast("bigint") + 1,
        "shown": lambda: F.trim(c).try_cast("bigint"),
    }[how]()
    return df.withColumn("n_pages", value)


def expand_pages(df: DataFrame, n_pages: str, start: int) -> DataFrame:
    """Page numbers: 0 .. n-1 from 0, or 2 .. n when the first page was read already."""
    last = F.col(n_pages) - 1 if start == 0 else F.col(n_pages)
    return df.where(last >= start).withColumn("page", F.explode(F.sequence(F.lit(start).cast("long"), last.cast("long"))))


def progress(df: DataFrame, caption: str) -> DataFrame:
    """'a - b of N': rows reached, rows in all, and whether the end is reached."""
    c = F.col(caption)
    shown = F.substring_index(F.substring_index(c, " of ", 1), " - ", -1).try_cast("bigint")
    total = F.substring_index(c, " of ", -1).try_cast("bigint")
    return df.withColumn("reached", shown).withColumn("total", total).withColumn("done", F.col("total") - F.col("reached") == 0)


def band(df: DataFrame, column: str, bands: DataFrame) -> DataFrame:
    """Attach every band that holds the value; overlapping bands give several rows, none gives no row."""
    points = bands.withColumn("_point", F.explode(F.sequence("age_lo", "age_hi")))
    return df.join(points, F.col(column).cast("int") == F.col("_point")).drop("_point")


def code_list(df: DataFrame, html: str, tag: str = "option", select: str | None = None) -> DataFrame:
    """Values of the options of the select box with this id (null: of all boxes) in order.

    Scripts and comments do not count; options without a value are skipped.
    """
    body = H.content(F.col(html))
    if select is not None:
        opening = rf"""(?is)<select\s(?:[^>]*?\s)?id\s*=\s*["']?{re.escape(select)}["'\s>].*?</select"""
        body = F.regexp_extract(body, opening, 0)
    opened = F.regexp_extract_all(body, F.lit(rf'(?is)<{tag}\s(?:[^>]*?\s)?value\s*=\s*"([^"]*)"'), F.lit(1))
    kept = [c for c in df.columns if c != html]
    return df.select(*kept, F.posexplode_outer(opened).alias("pos", "code")).where(F.col("pos").isNotNull())


def pager(pages: DataFrame, how: str, into: str = "last", html: str = "html") -> DataFrame:
    """What a listing's pager says about its last page, for `last_page` to read.

    titled: target of the link titled 'Go to last page'; shown: text in front of the next-page item.
    """
    body = H.content(F.col(html))
    if how == "titled":
        found = H.titled_href(body, "Go to last page")
    elif how == "shown":
        found = F.nullif(strip(H.plain(H.before_class(body, "li", "next-page"))), F.lit(""))
    else:
        raise ValueError(f"unknown pager {how!r}")
    return pages.withColumn(into, found).drop(html)
