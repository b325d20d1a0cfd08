"""Regions of a page chosen by tag and class, which may nest and so need a tag stack.

One walk over the tags of a page lists its elements, and every scope asked of the page is answered from that list. This
is the one Python step of the package: a pandas UDF that gets markup and scopes, in Arrow batches, each page on its own.
Scripts, styles and comments are removed before, in the JVM.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill.functions.html import content

# The functions below travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>""")
CLASS = re.compile(r"""(?is)(?:^|\s)class\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
FIRST_CLASS = r"\.([^\s\[>]+)"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


STEP = re.compile(r"^(all )?([^.\[]*)(?:\.([^\[]*))?(?:\[(-?\d+)\])?$")


def parse_scope(scope: str) -> list[tuple[int | None, str, list[str]]]:
    """Steps from the outside in: (ordinal, tag, classes); the ordinal of 'all' is None.

    'div.view-content > all tbody' reads: every table body in the first such div;
    'td[-3]' is the third cell from the end, 'td > *' is every child of the first cell.
    """
    steps = []
    for word in scope.split(" > "):
        parsed = STEP.match(word.strip())
        if not parsed:
            raise ValueError(f"cannot read scope step {word!r}")
        every, tag, classes, ordinal = parsed.groups()
        steps.append((None if every else int(ordinal or 1), tag.strip().lower(), (classes or "").split()))
    return steps


def _is_match(name: str, attributes: str, tag: str, classes: list[str]) -> bool:
    if tag and name != tag:
        return False
    if not classes:
        return True
    held = CLASS.search(attributes)
    found = (held[1] or held[2] or held[3] or "").split() if held else []
    return classes[0] in found if len(classes) == 1 else found == classes


class Elements:
    """The elements of a page in the order of their opening tags; a closing tag also ends what was left open inside it.

    An element spans starts[i] to ends[i], its inner markup inner[i] to inner_ends[i]. `firsts` are the first steps of all
    scopes asked: if each takes the k-th element from the start, the walk ends when these are closed, as all other steps
    stay inside them.
    """

    def __init__(self, markup: str, firsts: list[tuple[int | None, str, list[str]]] | None = None):
        self.markup = markup
        self.starts: list[int] = []
        self.inner: list[int] = []
        self.inner_ends: list[int] = []
        self.ends: list[int] = []
        self.tags: list[tuple[str, str]] = []
        self.named: dict[str, list[int]] = {}
        open_tags: list[int] = []
        n_open: dict[str, int] = {}
        starts, inner, inner_ends, ends, tags, named = self.starts, self.inner, self.inner_ends, self.ends, self.tags, self.named
        whole = len(markup)
        counted = bool(firsts) and all((ordinal or 0) > 0 and tag != "*" for ordinal, tag, _ in firsts)
        left = [list(first) for first in firsts] if counted else []
        to_close: set[int] = set()
        for token in TAG.finditer(markup):
            closing, name, attributes = token.groups()
            begin, end = token.span()
            name = name.lower()
            if not closing:
                number = len(starts)
                starts.append(begin)
                inner.append(end)
                tags.append((name, attributes))
                if name in named:
                    named[name].append(number)
                else:
                    named[name] = [number]
                if name in VOID or attributes[-1:] == "/":
                    inner_ends.append(end)
                    ends.append(end)
                else:
                    inner_ends.append(whole)
                    ends.append(whole)
                    open_tags.append(number)
                    n_open[name] = n_open.get(name, 0) + 1
                for step in left:
                    if _is_match(name, attributes, *step[1:]):
                        step[0] -= 1
                        if step[0] == 0 and ends[number] == whole:
                            to_close.add(number)
                if left:
                    left = [step for step in left if step[0]]
                if counted and not left and not to_close:
                    return
            elif n_open.get(name):
                while True:
                    number = open_tags.pop()
                    shut = tags[number][0]
                    n_open[shut] -= 1
                    inner_ends[number] = ends[number] = begin
                    to_close.discard(number)
                    if shut == name:
                        ends[number] = end
                        break
                if counted and not left and not to_close:
                    return

    def children(self, begin: int, end: int) -> list[tuple[int, int]]:
        """Spans of elements and bare texts at the top of a span, in order."""
        spans, at = [], begin
        number = bisect_left(self.starts, begin)
        while number < len(self.starts) and self.starts[number] < end:
            spans += [(at, self.starts[number]), (self.starts[number], self.ends[number])]
            at = self.ends[number]
            number = bisect_left(self.starts, at, number + 1)
        return [(a, b) for a, b in [*spans, (at, end)] if a < b]

    def select(self, begin: int, end: int, ordinal: int | None, tag: str, classes: list[str]) -> list[tuple[int, int]]:
        """Spans that one step of a scope selects inside a span."""
        if tag == "*":
            return self.children(begin, end)
        low, high = bisect_left(self.starts, begin), bisect_left(self.starts, end)
        if tag:
            own = self.named.get(tag, [])
            numbers = own[bisect_left(own, low) : bisect_left(own, high)]
        else:
            numbers = range(low, high)
        hits, left = [], None if ordinal is None else abs(ordinal)
        for number in numbers if ordinal is None or ordinal > 0 else reversed(numbers):
            if left == 0:
                break
            if _is_match(*self.tags[number], tag, classes):
                hits.append((self.inner[number], self.inner_ends[number]))
                left = None if left is None else left - 1
        # an ordinal takes the last one found of so many
        return hits if left is None else hits[-1:] if left == 0 and ordinal else []

    def regions(self, steps: list) -> list[str]:
        """Regions that the steps of a scope select, in document order."""
        spans = [(0, len(self.markup))]
        for step in steps:
            spans = [inner for span in spans for inner in self.select(*span, *step)]
        return [self.markup[a:b] for a, b in spans]


def regions_of(markup: str, scope: str) -> list[str]:
    """Regions a scope selects, in document order."""
    steps = parse_scope(scope)
    return Elements(markup, steps[:1]).regions(steps)


def _answers(markup: pd.Series, scopes: pd.Series) -> pd.Series:
    """For each page and scope the regions; pages without markup have no scopes asked."""
    steps = {scope: parse_scope(scope) for asked in scopes for scope in asked}

    def answer(page: str | None, asked: list[str]) -> list[list[str]]:
        if page is None or not len(asked):
            return []
        elements = Elements(page, [steps[scope][0] for scope in asked])
        return [elements.regions(steps[scope]) for scope in asked]

    return pd.Series([answer(*row) for row in zip(markup, scopes)], index=markup.index)


def page_regions(pages: DataFrame, scopes: str = "scopes", html: str = "html", into: str = "regions") -> DataFrame:
    """The regions of each page for all its scopes, as an array of (kind, region_no, region), instead of the page column.

    `scopes` names an array of (kind, scope). A null or empty scope is the whole page, without scripts, styles and
    comments; without any scope a page has no regions. Only pages that hold the first class name of a scope go to Python, and only with such scopes.
    """
    none = F.array().cast(pages.schema[scopes].dataType)
    clean = pages.withColumns({html: content(F.col(html)), scopes: F.coalesce(scopes, none)})
    whole = F.coalesce(F.col(html).isNotNull(), F.lit(False))
    asked = F.filter(
        scopes,
        lambda s: whole & (s["scope"] != "") & F.contains(F.col(html), F.coalesce(F.regexp_extract(s["scope"], FIRST_CLASS, 1), F.lit(""))),
    )
    plain = F.filter(scopes, lambda s: whole & (F.coalesce(s["scope"], F.lit("")) == ""))
    sorted_out = clean.withColumns({"_asked": asked, "_plain": plain}).drop(scopes)
    answers = F.pandas_udf(_answers, "array<array<string>>")
    markup = F.when(F.size("_asked") > 0, F.col(html))
    answered = sorted_out.withColumn("_found", answers(markup, F.transform("_asked", lambda s: s["scope"])))

    def region(kind: Column, number: Column, text: Column) -> Column:
        return F.struct(kind.alias("kind"), number.cast("bigint").alias("region_no"), text.alias("region"))

    uncut = F.transform("_plain", lambda s: region(s["kind"], F.lit(0), F.col(html)))
    cut = F.transform(
        "_asked", lambda s, i: F.transform(F.get(F.col("_found"), i), lambda text, number: region(s["kind"], number, text))
    )
    every = F.concat(uncut, F.flatten(cut))
    return answered.withColumn(into, every).drop("_asked", "_plain", "_found", html)


def kind_regions(pages: DataFrame, scopes: str = "scopes", html: str = "html") -> DataFrame:
    """One row per region of `page_regions`, its kind, number and markup in place of the page and its scopes."""
    found = page_regions(pages, scopes, html, "_regions")
    kept = [c for c in found.columns if c != "_regions"]
    # the outer form keeps the optimizer from testing the array first, which would compute it twice
    rows = found.select(*kept, F.explode_outer("_regions").alias("_region")).where(F.col("_region").isNotNull())
    return rows.select(*kept, "_region.kind", "_region.region_no", "_region.region")


def scoped_regions(pages: DataFrame, scope: str = "scope", html: str = "html") -> DataFrame:
    """One row per selected region of each page; `scope` names the column holding the page's rule.

    A page without a scope is one region, itself. The page column is replaced by
    `region_no` and `region`. Pages that do not hold the scope's first class name at all are
    left out by a substring test before anything goes to Python.
    """
    one = F.array(F.struct(F.lit("").alias("kind"), F.col(scope).alias("scope")))
    found = page_regions(pages.withColumn("_scopes", one).drop(scope), "_scopes", html, "_regions")
    kept = [c for c in found.columns if c != "_regions"]
    rows = found.select(*kept, F.explode_outer("_regions").alias("_region")).where(F.col("_region").isNotNull())
    return rows.select(*kept, "_region.region_no", "_region.region")
