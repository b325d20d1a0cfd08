"""Document, penalty and notice records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regmill import rules as R
from regmill.functions import dates as D
from regmill.functions.identity import keyed_id
from regmill.functions.text import split_at_patterns


def enrich(df: DataFrame, sources: DataFrame, on: str = "source") -> DataFrame:
    """Constants of each row's source."""
    return df.join(sources, on)


def of_source(df: DataFrame, source: str) -> DataFrame:
    """The constants of one known source, as literals rather than a join on a constant."""
    names = ["doc_source_type", "doc_source", "entity_type", "relationship_type"]
    values = next(row[1:] for row in R.SOURCES if row[0] == source)
    return df.withColumns({n: F.lit(v).cast("string") for n, v in zip(names, values)})


def merge_right(left: DataFrame, right: DataFrame, key: str, found: str | None = None) -> DataFrame:
    """Join in which the right side's value stands for every shared column, null or not.

    With `found`, rows without a partner stay as they are, and the column of that name is null in them, else true.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    if found is None:
        return left.drop(*shared).join(right, key)
    own = left.withColumnsRenamed({c: f"_left_{c}" for c in shared})
    joined = own.join(right.withColumn(found, F.lit(True)), key, "left")
    merged = {c: F.when(F.col(found), F.col(c)).otherwise(F.col(f"_left_{c}")) for c in shared}
    return joined.withColumns(merged).drop(*[f"_left_{c}" for c in shared])


def split_rejects(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): a row failing a check is set aside with the first reason, the rest go on."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()])
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def normalize_dates(df: DataFrame, column: str, fmt: str, into: str) -> DataFrame:
    return df.withColumn(into, D.iso_midnight(F.col(column), fmt))


def repair_dates(df: DataFrame, column: str, fixes: DataFrame) -> DataFrame:
    """Literal corrections applied before parsing."""
    fixes = fixes.select(F.col("raw").alias(column), "fixed")
    return df.join(fixes, column, "left").withColumn(column, F.coalesce("fixed", column)).drop("fixed")


def fiscal_stamp(df: DataFrame, year: str) -> DataFrame:
    """Title and both record times of a fiscal year."""
    end = D.fiscal_year_end(F.col(year))
    return df.withColumns(
        {
            "message_title": F.concat(F.lit("PENALTY COLLECTIONS FY "), F.col(year).cast("string")),
            "time_master": end,
            "time_document": end,
        }
    )


def stamp(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Load times; never part of an id."""
    now = F.current_timestamp() if as_of is None else as_of
    return df.withColumns({"time_collected": now, "time_uploaded": now})


def parse_amount(df: DataFrame, column: str, into: str) -> DataFrame:
    """All digits of the text as one integer (cents fold in); null without digits."""
    digits = F.regexp_replace(F.col(column), "[^0-9]", "")
    return df.withColumn(into, digits.try_cast("bigint"))


def split_regulation(df: DataFrame, column: str, on_no_match: str = "drop") -> DataFrame:
    """Violation text and cited regulation; a text without a known pattern gives neither, or all of it as violation."""
    violation, regulation = split_at_patterns(F.col(column), R.REGULATION_PATTERNS)
    if on_no_match == "violation":
        violation = F.coalesce(violation, F.col(column))
    elif on_no_match != "drop":
        raise ValueError("on_no_match is 'drop' or 'violation'")
    return df.withColumns({"violation": violation, "regulation": F.concat(regulation, F.lit(" "))})


def canonical_message(df: DataFrame, into: str = "message") -> DataFrame:
    """Record fields joined in field order; one missing field makes it null, which rejects the record."""
    fields = [f for f in R.DOCUMENT_FIELDS if f not in R.ID_EXCLUDES]
    return df.withColumn(into, F.concat(*[F.col(f) for f in fields]))


def document_id(df: DataFrame, message: str, key_hex: str, into: str = "document_id") -> DataFrame:
    return df.withColumn(into, keyed_id(F.col(message), key_hex))


def explode_notices(responses: DataFrame, body: str = "body", unlinked: bool = False) -> DataFrame:
    """One row per notice that links to its detail; the picture link may be missing.

    With `unlinked`, notices without the link stay, `detail_url` null.
    """
    n = F.col("n")
    rows = responses.select(F.explode(F.col(f"{body}._embedded.notices")).alias("n"))
    rows = rows if unlinked else rows.where(n["_links"]["self"]["href"].isNotNull())
    return rows.select(
        "n.*",
        n["_links"]["self"]["href"].alias("detail_url"),
        n["_links"]["thumbnail"]["href"].alias("entity_profile_image_url"),
    )


def promote_first(df: DataFrame, array: str, empty: bool = False) -> DataFrame:
    """Fields of the first element as columns, replacing columns of the same name; no element rejects the row.

    With `empty`, rows without an element stay, the fields null.
    """
    first = F.get(F.col(array), F.lit(0))
    fields = df.schema[array].dataType.elementType.names
    kept = (df if empty else df.where(F.size(array) > 0)).withColumn("_first", first)
    return kept.withColumns({f: F.col("_first")[f] for f in fields}).drop("_first")


def rename_notice(df: DataFrame, kind: str) -> DataFrame:
    """Notice keys to record fields, service keys removed; a missing key is an error."""
    red = kind == "red"
    renames = {**R.NOTICE_RENAMES, **(R.RED_RENAMES if red else {})}
    missing = [c for c in renames if c not in df.columns]
    if missing:
        raise ValueError(f"notice lacks {missing}")
    drops = [*R.NOTICE_DROPS, *(R.RED_DROPS if red else [])]
    return df.drop(*drops).withColumnsRenamed(renames)


def normalize_dob(df: DataFrame, column: str = "date_of_birth", into: str = "entity_dob") -> DataFrame:
    return df.withColumn(into, D.birth_date(F.col(column)))


def _is_list(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("ARRAY")), F.lit(False))


def fold_attributes(df: DataFrame, into: str = "entity_notes") -> DataFrame:
    """Physical attributes as one note 'k: v; k: v;'; a list stands by its last item, absent ones are left out.

    A value may be a list, its JSON text or a variant, whose type is each row's own. Text that is no JSON list stands
    as it is, so numbers keep their printed form; variants print numbers without closing zeros and objects as JSON.
    """
    parts = []
    for name in [c for c in R.FOLDED_ATTRIBUTES if c in df.columns]:
        c = F.col(name)
        kind = df.schema[name].dataType.typeName()
        if kind == "array":
            c = F.try_element_at(c, F.lit(-1))
        elif kind == "string":
            last = F.try_element_at(F.from_json(c, "array<string>"), F.lit(-1))
            c = F.when(_is_list(F.try_parse_json(c)), last).otherwise(c)
        elif kind == "variant":
            last = F.try_element_at(F.try_variant_get(c, "$", "array<variant>"), F.lit(-1))
            c = F.when(_is_list(c), last.cast("string")).otherwise(c.cast("string"))
        parts.append(F.when(c.isNotNull(), F.concat(F.lit(f"{name}: "), c.cast("string"), F.lit(";"))))
    joined = F.concat_ws(" ", *parts)
    note = F.when(joined != "", F.concat(F.lit(R.FOLD_PREFIX), joined))
    return df.withColumn(into, note).drop(*R.FOLDED_ATTRIBUTES)


def to_sparse(df: DataFrame, key: str, into: str = "document") -> DataFrame:
    """Records as JSON objects that hold only the keys with a value."""
    return df.select(key, F.to_json(F.struct(*df.columns)).alias(into))
