"""The flows written to their stores and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmill import rules
from regmill.operators import store as S
from regmill.operators import versions as V
from regmill.plans import collection, notices, penalties, releases, sinks
from regmill.plans.catalog import derived
from regmill.plans.catalog.flow_queries import (
    FDA_RULE,
    MASTER,
    PENALTY_SQL,
    RELEASES_SQL,
    agency_sites,
    archive_targets,
    documents_sql,
    listing_pages,
    release_pages,
)
from regmill.plans.catalog.record_queries import RED_SQL, details, responses
from regmill.plans.catalog.registry import DEMO_KEY, query, sql_keyed_id, table
from regmill.session import fresh_dir, written

CLOCK = "2024-01-01 00:00:00"
SOURCE_URL, DOCUMENT_URL = "https://agency.example/penalties", "https://agency.example/penalties.pdf"

RULED_SQL = f"""
    SELECT site, CASE site WHEN 'ams' THEN 'www_ams_usda_gov' WHEN 'fcc' THEN 'www_fcc_gov' WHEN 'treasury' THEN 'ofac_treasury_gov'
                     WHEN 'railroads' THEN 'railroads_dot_gov' ELSE 'assets_pcaobus_org' END AS folder,
           CASE WHEN site IN ('fcc', 'treasury') THEN year END AS year, seq, o_custkey,
           CASE site WHEN 'ams' THEN 'My File' WHEN 'railroads' THEN 'f ' WHEN 'pcaob' THEN 'f' ELSE '' END || o_custkey || '.pdf' AS file_name
    FROM (SELECT {derived.RULED_SITE} AS site, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS seq, o_custkey FROM orders)"""


@query(
    "stored_files",
    f"""
    SELECT folder, year, file_name, CASE WHEN min(o_custkey % 2) = 0 THEN 'load 0 ' ELSE 'load 1 ' END || file_name AS content,
           CAST(min(o_custkey % 2) AS BIGINT) AS load
    FROM ({RULED_SQL}) WHERE o_custkey % 10 <> 9 GROUP BY folder, year, file_name""",
)
def stored_files(spark, sf):
    """Files of five sites in two loads. The first can fetch every second file, the second fetches all but some and
    the first is started again after it: what was held stays, the rest is added to the same folders."""
    root = fresh_dir(spark, "stored")
    none = rules.local_frame(spark, [], rules.DENY_SCHEMA)
    files = collection.site_files(derived.ruled_pages(spark, sf), rules.site_rules(spark), rules.year_rules(spark), none)
    files = written(files, "listed")
    number = F.regexp_extract("file_name", r"(\d+)\.pdf", 1).cast("bigint")
    fetched = files.select("target", "file_name", number.alias("n")).distinct()
    for token in ("first", "second", "first"):
        here = fetched.where("n % 2 = 0" if token == "first" else "true").where("n % 10 <> 9")
        label = "load 0 " if token == "first" else "load 1 "
        sinks.load_files(files, here.select("target", F.concat(F.lit(label), "file_name").alias("content")), root, token)
    return sinks.stored_files(spark, root, files).select("folder", "year", "file_name", "content", "load")


@query(
    "stored_page_texts",
    """
    SELECT 'www_agency_example ' || CASE site WHEN 'enforce' THEN 'Enforce' ELSE site END AS folder, year,
           'lr' || seq || '.txt' AS file_name,
           'Text & order ' || seq || ' see ' || chr(10) || source || chr(10)
             || CASE WHEN seq % 5 = 0 THEN 'again' ELSE '' END AS text
    FROM (SELECT *, """
    + derived.ROUTED_SITE.replace("o_orderpriority", "source")
    + f""" AS site FROM ({derived.LINKS_SQL}))
    WHERE href LIKE '%.htm' AND site <> 'admin' AND (site <> 'enforce' OR year >= 1999)
      AND (site <> 'litigation' OR href <> '/litigation/litreleases/lr7.htm')""",
)
def stored_page_texts(spark, sf):
    """Page texts of two loads: the texts of the second replace those of the first, the others stay."""
    root = fresh_dir(spark, "page-texts")
    pages = derived.archived_texts(spark, sf)
    texts = collection.page_texts(archive_targets(spark, sf), pages, rules.year_rules(spark), agency_sites(spark))
    texts = written(texts.select("folder", "year", "file_name", "text"), "texts")
    again = texts.where(F.regexp_extract("file_name", r"(\d+)\.txt", 1).cast("bigint") % 5 == 0)
    sinks.load_page_texts(texts, root, "one")
    sinks.load_page_texts(again.withColumn("text", F.concat("text", F.lit("again"))), root, "two")
    held = sinks.layout.read_layout(spark, root, texts.schema, ["folder", "year"], "file_name", wins=sinks.layout.LAST)
    return held.drop("load")


RELEASES = documents_sql("fda", MASTER, RELEASES_SQL)


def stored_releases(spark, sf):
    """The releases, sent twice."""
    root = fresh_dir(spark, "documents")
    documents, _ = releases.release_documents(listing_pages(spark, sf), release_pages(spark, sf), FDA_RULE, DEMO_KEY)
    documents = written(documents, "documents")
    for load in (0, 1):
        sinks.load_documents(documents, root, 0, load, as_of=F.to_timestamp(F.lit(CLOCK)))
    return root


@query(
    "stored_documents",
    f"""
    SELECT message_title, message_body, 'Press Release' AS doc_source_type, document_id, doc_source, '{MASTER}' AS doc_source_url,
           doc_source_pdf_url, '2024-01-01 00:00:00' AS time_collected, '2024-01-01 00:00:00' AS time_uploaded,
           time_master, time_master AS time_document, CAST(2 AS BIGINT) AS version
    FROM ({RELEASES})""",
)
def stored_documents(spark, sf):
    """Complete release records in the index after they were sent twice."""
    held = S.read_index(spark, stored_releases(spark, sf), ["document_id"], ["version"]).drop(*S.PLACE)
    return held.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("time_collected", "time_uploaded")})


@query(
    "repeated_documents",
    f"SELECT document_id, doc_source_pdf_url AS url, message_title, CAST(2 AS BIGINT) AS version FROM ({RELEASES})",
)
def repeated_documents(spark, sf):
    """The audit of the second sending: id, address and record."""
    audit = S.read_writes(spark, V.audit_root(stored_releases(spark, sf)))
    title = F.get_json_object("record", "$.message_title").alias("message_title")
    return audit.select("document_id", "url", title, "version")


@query(
    "stored_penalties",
    f"""
    SELECT {sql_keyed_id("coalesce(number, '') || coalesce(name, '')")} AS document_id, 'PENALTY COLLECTIONS FY ' || year AS message_title,
           name AS entity_full_name, number AS message_id, coalesce(summary, '') AS message_summary,
           coalesce(tags, '') AS message_tags, CAST(regexp_replace(payment, '[^0-9]', '', 'g') AS BIGINT) AS message_value,
           'Press Release' AS doc_source_type, 'department of interior, office of natural resources revenue' AS doc_source,
           '{SOURCE_URL}' AS doc_source_url, '{DOCUMENT_URL}' AS doc_source_pdf_url,
           year || '-12-31T00:00:00.000Z' AS time_master, year || '-12-31T00:00:00.000Z' AS time_document,
           '2024-01-01 00:00:00' AS time_collected
    FROM ({PENALTY_SQL}) WHERE payment <> 'n/a'""",
)
def stored_penalties(spark, sf):
    """Complete penalty records as they were written."""
    root = fresh_dir(spark, "penalties")
    records, _ = penalties.penalty_records(derived.penalty_rows(spark, sf), order=("row_no", "l_partkey"))
    sinks.load_penalties(records, root, DEMO_KEY, SOURCE_URL, DOCUMENT_URL, as_of=F.to_timestamp(F.lit(CLOCK)))
    held = S.read_writes(spark, root).drop(*S.PLACE, "version", "time_uploaded")
    return held.withColumn("time_collected", F.date_format("time_collected", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stored_notices",
    f"""
    SELECT {sql_keyed_id("entity_id")} AS document_id, entity_id, name, 'Red Notice' AS kind, '{SOURCE_URL}' AS url,
           charge, true AS timed, true AS sparse
    FROM ({RED_SQL})""",
)
def stored_notices(spark, sf):
    """Red notices as sparse records with source address and times."""
    root = fresh_dir(spark, "notices")
    documents, _ = notices.notice_documents(responses(spark, sf), details(spark, sf), "red", DEMO_KEY)
    sinks.load_notices(documents, root, "red", SOURCE_URL, F.to_timestamp(F.lit(CLOCK)))
    of = lambda k: F.get_json_object("document", f"$.{k}")
    times = [of(t).isNotNull() for t in ("time_master", "time_collected", "time_uploaded", "time_document")]
    return S.read_writes(spark, root).select(
        "document_id",
        of("entity_id").alias("entity_id"),
        of("entity_last_name").alias("name"),
        of("doc_source_type").alias("kind"),
        of("doc_source_url").alias("url"),
        of("relationship_details").alias("charge"),
        (times[0] & times[1] & times[2] & times[3]).alias("timed"),
        (~F.contains("document", F.lit(":null"))).alias("sparse"),
    )


@query("years_as_csv", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1999 GROUP BY 1")
def years_as_csv(spark, sf):
    """Table rows to one folder of delimited files per year without one of the years, a load per status."""
    root = fresh_dir(spark, "year-csv")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    for status in ("F", "O", "P"):
        S.write_csv_by(rows.where((F.col("o_orderstatus") == status) & (F.col("year") != 1999)), root, "year", ["o_orderkey"])
    held = spark.read.schema("o_orderkey bigint, o_orderstatus string, year int").csv(root)
    return held.groupBy("year").agg(F.count("*").alias("n"))
