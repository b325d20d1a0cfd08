"""Date texts to ISO strings. Dates carry no zone, so no session time zone can shift them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regmill.rules import DATE_FORMATS


def iso_midnight(c: Column, fmt: str) -> Column:
    """yyyy-MM-ddT00:00:00, null when the text does not follow the named format."""
    parsed = F.try_to_date(c, DATE_FORMATS[fmt])
    return F.concat(parsed.cast("string"), F.lit("T00:00:00"))


def iso_millis(day: Column) -> Column:
    return F.concat(day.cast("string"), F.lit("T00:00:00.000Z"))


def birth_date(c: Column) -> Column:
    """Full date, or a bare year taken as its first day; anything else is null."""
    pattern = "yyyy/M/d"
    return iso_millis(F.coalesce(F.try_to_date(c, pattern), F.try_to_date(F.concat(c, F.lit("/01/01")), pattern)))


def fiscal_year_end(year: Column) -> Column:
    return iso_millis(F.make_date(year, F.lit(12), F.lit(31)))
