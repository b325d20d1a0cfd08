"""Markup expressions for elements that do not nest; class-scoped regions live in operators.regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regmill.functions.text import decode_entities

NON_CONTENT = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
ANCHOR = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
QUOTES = "\"'"
ANY_TAG = r"(?s)<[^>]*>"
BLOCK_END = r"(?i)</(article|div|section|main|td|li|body|html)\s*>"
SINGLE_TEXT = r"(?s)^(?:<[A-Za-z][^>]*>)*([^<]+)(?:</[^>]*>)*$"
VOID_TAG = r"(?i)<(br|hr|img|input|wbr)\b"


def content(html: Column) -> Column:
    """Markup without scripts, styles and comments, whose text could be taken for tags."""
    return F.regexp_replace(html, NON_CONTENT, "")


def elements(html: Column, tag: str) -> Column:
    """Inner markup of every <tag>, in document order; for tags that do not contain themselves."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))


def hrefs(html: Column) -> Column:
    """Target of every anchor that has one, in document order."""
    raw = F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(1))
    return F.transform(raw, lambda x: decode_entities(F.btrim(x, F.lit(QUOTES))))


def paragraphs(html: Column) -> Column:
    """Inner markup of paragraphs; an unclosed one ends at the next <p> or when its block closes."""
    closed = F.regexp_replace(html, BLOCK_END, "</p></$1>")
    closed = F.concat(F.regexp_replace(closed, r"(?i)<p(\s[^>]*)?>", "</p><p>"), F.lit("</p>"))
    return F.regexp_extract_all(closed, F.lit(r"(?s)<p>(.*?)</p>"), F.lit(1))


def plain(markup: Column) -> Column:
    """Text of a fragment: tags removed, character references decoded."""
    return decode_entities(F.regexp_replace(markup, ANY_TAG, ""))


def attribute(markup: Column, name: str) -> Column:
    """First value of a double-quoted attribute, null when absent."""
    return F.nullif(F.regexp_extract(markup, rf'(?is)\s{name}\s*=\s*"([^"]*)"', 1), F.lit(""))


def classed(markup: Column, name: str) -> Column:
    """Inner markup of the first element of a class that holds no element of its own tag; '' when absent."""
    opened = rf'(?is)<([a-z][a-z0-9]*)\s(?:[^>]*\s)?class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"[^>]*>(.*?)</\1\s*>'
    return F.regexp_extract(markup, opened, 2)


def before_class(markup: Column, tag: str, name: str) -> Column:
    """Inner markup of the element right in front of the first one of a class; '' when there is none."""
    inner = rf"((?:[^<]+|<(?!/?{tag}\b))*+)"
    behind = rf'<{tag}\s(?:[^>]*\s)?class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"'
    return F.regexp_extract(markup, rf"(?is)<{tag}(?:\s[^>]*)?>{inner}</{tag}\s*>\s*{behind}", 1)


def titled_href(markup: Column, title: str) -> Column:
    """Target of the first anchor with a title; null when there is none."""
    tag = F.regexp_extract(markup, rf'(?is)<a\s(?:[^>]*\s)?title\s*=\s*"{title}"[^>]*>', 0)
    return F.try_element_at(hrefs(tag), F.lit(1))
