"""Rows and texts out of page markup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.functions.text import cut_before, strip
from regmill.rules import TEASER_DATE_CLASS


def _unnest(pages: DataFrame, html: str, array: Column, pos: str, value: str) -> DataFrame:
    """One row per element, the page column replaced by place and value.

    The outer form keeps the optimizer from testing the array first, which would run its
    expressions twice; callers filter the generated column, which cannot be pushed below.
    """
    kept = [c for c in pages.columns if c != html]
    rows = pages.select(*kept, F.posexplode_outer(array).alias(pos, value))
    return rows.where(F.col(pos).isNotNull())


def extract_links(pages: DataFrame, html: str = "html", clean: bool = False) -> DataFrame:
    """Every link in document order; links without a target are dropped, positions are kept.

    `clean` says that scripts, styles and comments are out already, as in regions.
    """
    markup = F.col(html) if clean else H.content(F.col(html))
    return _unnest(pages, html, H.hrefs(markup), "pos", "href").where(F.col("href") != "")


def tag_region(pages: DataFrame, tag: str, html: str = "html") -> DataFrame:
    """The first element of a tag that does not nest, instead of the whole page."""
    found = F.slice(H.elements(H.content(F.col(html)), tag), 1, 1)
    return _unnest(pages, html, found, "_no", html).drop("_no")


def nth_region(pages: DataFrame, tag: str, ordinal: Column, into: str = "region", html: str = "html") -> DataFrame:
    """The k-th element of a tag, counted from the end when negative; null past either end."""
    return pages.withColumn(into, F.try_element_at(H.elements(H.content(F.col(html)), tag), ordinal))


def first_region(pages: DataFrame, tag: str, into: str = "region", html: str = "html") -> DataFrame:
    return nth_region(pages, tag, F.lit(1), into, html)


def first_link(pages: DataFrame, into: str = "href", html: str = "html") -> DataFrame:
    """The first link of each page or region; those without one drop out."""
    found = F.slice(H.hrefs(H.content(F.col(html))), 1, 1)
    return pages.select("*", F.explode_outer(found).alias(into)).where(F.col(into) != "")


def extract_table(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows of the first table body as trimmed cell texts; rows may differ in length."""
    body = F.try_element_at(H.elements(H.content(F.col(html)), "tbody"), F.lit(1))
    rows = F.transform(
        H.elements(body, "tr"), lambda row: F.transform(H.elements(row, "td"), lambda cell: strip(H.plain(cell)))
    )
    return _unnest(pages, html, rows, "row_no", "cells")


def extract_listing(pages: DataFrame, kind: str, root: str, prefix: str = "", html: str = "html") -> DataFrame:
    """(date, title, link) of each listed release.

    kind 'table': date in the first cell, title and link in the second; 'cards': list items
    holding a link whose text is the title, no date; 'teasers': the markup is one teaser with a
    dated element, a heading and a link padded with blanks.
    """

    def item(date: Column, title: Column, markup: Column) -> Column:
        link = F.try_element_at(H.hrefs(markup), F.lit(1))
        return F.struct(date.alias("date"), title.alias("title"), link.alias("href"))

    body = H.content(F.col(html))
    if kind == "table":
        region = F.try_element_at(H.elements(body, "tbody"), F.lit(1))
        cells = F.transform(H.elements(region, "tr"), lambda row: H.elements(row, "td"))
        pairs = F.transform(
            cells,
            lambda c: F.struct(F.try_element_at(c, F.lit(1)).alias("date"), F.try_element_at(c, F.lit(2)).alias("cell")),
        )
        items = F.transform(pairs, lambda p: item(H.plain(p["date"]), H.plain(p["cell"]), p["cell"]))
    elif kind == "cards":
        title = lambda li: strip(H.plain(F.try_element_at(H.elements(li, "a"), F.lit(1))))
        items = F.transform(H.elements(body, "li"), lambda li: item(F.lit(None).cast("string"), title(li), li))
    elif kind == "teasers":
        date = strip(H.plain(H.classed(body, TEASER_DATE_CLASS)))
        title = strip(H.plain(F.try_element_at(H.elements(body, "h3"), F.lit(1))))
        items = F.array(item(date, title, body))
    else:
        raise ValueError(f"unknown listing kind {kind!r}")
    rows = _unnest(pages, html, items, "pos", "_item")
    href = F.col("_item.href")
    linked = rows.where(F.startswith(href, F.lit(prefix)))
    if prefix.startswith(" "):
        href = F.try_element_at(F.split(F.trim(href), r"\s+"), F.lit(1))
    link = F.concat(F.lit(root), href).alias("link")
    return linked.select(*[c for c in rows.columns if c != "_item"], "_item.date", "_item.title", link)


def body_text(pages: DataFrame, mode: str, marker: Column | str | None = None, into: str = "body", html: str = "html") -> DataFrame:
    """Message body of a page.

    leaves: paragraphs that hold exactly one text, joined without separator
    first:  text of the first paragraph
    region: all text, cut at the marker
    lines:  one trimmed line per paragraph, each cut at the marker and ended by a newline
    """
    body = H.content(F.col(html))
    paragraphs = H.paragraphs(body)
    if mode == "leaves":
        single = F.filter(paragraphs, lambda p: p.rlike(H.SINGLE_TEXT) & ~p.rlike(H.VOID_TAG))
        text = F.array_join(F.transform(single, H.plain), "")
    elif mode == "first":
        text = H.plain(F.try_element_at(paragraphs, F.lit(1)))
    elif mode == "region":
        text = cut_before(H.plain(body), marker)
    elif mode == "lines":
        text = F.array_join(
            F.transform(paragraphs, lambda p: F.concat(cut_before(strip(H.plain(p)), marker), F.lit("\n"))), ""
        )
    else:
        raise ValueError(f"unknown body mode {mode!r}")
    return pages.withColumn(into, text)


def labelled_date(df: DataFrame, text: str, into: str = "date", label: str = "Date:") -> DataFrame:
    """Text between the label and the second comma, its first comma removed; null without label or comma."""
    tail = F.try_element_at(F.split(F.col(text), label), F.lit(2))
    parts = F.split(tail, ",")
    return df.withColumn(into, F.concat(F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))))
