"""Press releases: listing rows joined to their release pages become keyed documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.operators import records as R
from regmill.operators.extract import body_text, extract_listing, first_region, labelled_date
from regmill.operators.ordered import first_seen, since_mark
from regmill.operators.regions import scoped_regions
from regmill.rules import DOCUMENT_FIELDS, ID_EXCLUDES, ReleaseRule, date_fixes
from regmill.session import written


def _in_scope(pages: DataFrame, scope: str | None) -> DataFrame:
    """Pages cut down to their region; `region_no` tells several regions of a page apart."""
    if scope is None:
        return pages.withColumn("region_no", F.lit(0).cast("bigint"))
    return scoped_regions(pages.withColumn("scope", F.lit(scope))).withColumnRenamed("region", "html")


def release_listing(pages: DataFrame, rule: ReleaseRule) -> DataFrame:
    """(source, pos, date, title, link) of listing pages (seq, html); `pos` orders rows over all pages."""
    regions = _in_scope(pages.select("seq", "html"), rule.listing_scope)
    rows = extract_listing(regions, rule.listing, rule.root, rule.link_prefix)
    place = F.struct("seq", "region_no", "pos").alias("pos")
    return rows.select(F.lit(rule.source).alias("source"), place, "date", "title", "link")


def release_details(pages: DataFrame, rule: ReleaseRule) -> DataFrame:
    """(link, message_body[, date]) of release pages (url, html); pages without the region drop out."""
    regions = _in_scope(pages.select(F.col("url").alias("link"), "html"), rule.detail_scope)
    bodies = body_text(regions, rule.body, rule.marker, "message_body")
    if not rule.date_on_page:
        return bodies.select("link", "message_body")
    dated = first_region(bodies, "li", "_item").withColumn("_item", H.plain(F.col("_item")))
    dated = labelled_date(dated, "_item", "date")
    return dated.select("link", "message_body", F.trim("date").alias("date"))


def release_records(listing: DataFrame, details: DataFrame, rule: ReleaseRule) -> DataFrame:
    """Listing rows with body, date and source constants.

    Equal listing rows give equal records, so they are reduced to the first one before bodies are joined.
    A row whose release page is missing, or lacks the region of the text, stays without body.
    """
    once = first_seen(listing, ["title", "date", "link"], ["source"], ["pos"])
    joined = (once.drop("date") if rule.date_on_page else once).join(details, "link", "left")
    repaired = R.repair_dates(joined, "date", date_fixes(listing.sparkSession)) if rule.date_on_page else joined
    dated = R.normalize_dates(repaired, "date", rule.date_format, "time_master")
    return R.of_source(dated, rule.source).withColumns(
        {
            "message_title": F.col("title"),
            "doc_source_url": F.lit(rule.master_url),
            "doc_source_pdf_url": F.col("link"),
            "time_document": F.col("time_master"),
        }
    )


def keyed_documents(records: DataFrame, key_hex: str) -> tuple[DataFrame, DataFrame]:
    """(documents with their id, rejects): a record without a body or with any field missing has no id."""
    fields = [f for f in DOCUMENT_FIELDS if f not in ID_EXCLUDES]
    complete = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in fields])
    good, bad = R.split_rejects(
        records, {"no release page": F.col("message_body").isNotNull(), "field missing": complete}
    )
    return R.document_id(R.canonical_message(good), "message", key_hex).drop("message"), bad


def release_documents(
    listing_pages: DataFrame, detail_pages: DataFrame, rule: ReleaseRule, key_hex: str, marks: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(documents, rejects) of one source; with marks (source, mark) only what is listed in front of them.

    The mark is looked for before rows are cut at it, so the listing is written once and pages are parsed once.
    """
    listing = release_listing(listing_pages, rule)
    if marks is not None:
        listing = since_mark(written(listing, "listing"), marks, ["source"], "title", "pos")
    records = release_records(listing, release_details(detail_pages, rule), rule)
    return keyed_documents(records, key_hex)
