"""String expressions shared by extraction and record building."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from regmill.rules import NAMED_ENTITIES, UNICODE_SPACES


def bind(c: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also inside array lambdas."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space, not only the blank that SQL trim removes."""
    return F.btrim(c, F.lit(UNICODE_SPACES))


def cut_before(c: Column, marker: Column | str) -> Column:
    """Text in front of a literal marker; the whole text when the marker is absent."""
    if isinstance(marker, str):
        if not marker:
            raise ValueError("marker must not be empty")
        return F.substring_index(c, marker, 1)
    at = F.instr(c, marker)
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)


def after_last(c: Column, marker: str) -> Column:
    return F.substring_index(c, marker, -1)


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower (whole string, not per word)."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, F.lit(2), F.length(c))))


def _entity_map() -> Column:
    quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for pair in NAMED_ENTITIES for v in pair]
    return F.expr("map(" + ", ".join(f"'{v}'" for v in quoted) + ")")


def decode_entities(c: Column) -> Column:
    """Named and numeric character references to text, in one pass; unknown ones stay as they are."""
    known = _entity_map()

    def after_ampersand(part: Column, i: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        decimal = F.regexp_extract(name, "^#([0-9]+)$", 1).try_cast("bigint")
        hexadecimal = F.nullif(F.regexp_extract(name, "^#[xX]([0-9A-Fa-f]+)$", 1), F.lit(""))
        number = F.coalesce(decimal, F.conv(hexadecimal, 16, 10).try_cast("bigint"))
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        value = F.coalesce(F.try_element_at(known, name), F.when(valid, char).when(number.isNotNull(), "\ufffd"))
        rest = F.substring(part, F.length(name) + 2, F.length(part))
        decoded = F.when(F.contains(part, F.lit(";")), F.concat(value, rest))
        return F.when(i == 0, part).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), part)))

    def decoded(text: Column) -> Column:
        pieces = F.transform(F.split(text, "&"), after_ampersand)
        return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)

    return bind(c, decoded)


def split_at_patterns(c: Column, patterns: list[str]) -> tuple[Column, Column]:
    """Cut at the first pattern of the list (list order, not position) found in the text.

    Returns (before, from the pattern on); both null when no pattern occurs.
    """
    at = F.coalesce(*[F.nullif(F.instr(c, p), F.lit(0)) for p in patterns])
    return F.substring(c, F.lit(1), at - 1), F.substring(c, at, F.length(c))
