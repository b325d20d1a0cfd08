"""The whole flows, from pages, responses or table rows to what is stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmill import rules
from regmill.functions import html as H
from regmill.functions import urls as U
from regmill.operators import extract as X
from regmill.operators.links import resolve_links
from regmill.operators.ordered import count_by, first_seen, high_water
from regmill.plans import collection, penalties, releases
from regmill.plans.catalog import derived
from regmill.plans.catalog.derived import LINKS_SQL, ROOT, order_pages
from regmill.plans.catalog.page_queries import PAGE_LINKS_SQL, pages
from regmill.plans.catalog.registry import (
    DEMO_KEY,
    query,
    sql_content,
    sql_keyed_id,
    sql_paragraphs,
    sql_plain,
    table,
)

AS_OF = "2024-01-01T00:00:00"
MASTER = f"{ROOT}/releases"


@query(
    "page_documents",
    f"""
    SELECT *, {sql_keyed_id("message_title || message_body || 'Press Release' || doc_source || '" + MASTER + "' || doc_source_pdf_url || '" + AS_OF + AS_OF + "'")} AS document_id
    FROM (SELECT {sql_plain("regexp_extract(" + sql_content() + ", '(?is)<h1>(.*?)</h1>', 1)")} AS message_title,
                 {sql_plain("(" + sql_paragraphs(sql_content()) + ")[1]")} AS message_body,
                 replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '.', '_') AS doc_source, url AS doc_source_pdf_url
          FROM pages)""",
)
def page_documents(spark, sf):
    """Each page as a keyed document: heading, first paragraph, site."""
    titled = X.first_region(pages(spark, sf), "h1")
    records = X.body_text(titled, "first", into="message_body").select(
        H.plain(F.col("region")).alias("message_title"),
        "message_body",
        F.lit("Press Release").alias("doc_source_type"),
        U.site_folder(F.col("url")).alias("doc_source"),
        F.lit(MASTER).alias("doc_source_url"),
        F.col("url").alias("doc_source_pdf_url"),
        F.lit(AS_OF).alias("time_master"),
        F.lit(AS_OF).alias("time_document"),
    )
    documents, _ = releases.keyed_documents(records, DEMO_KEY)
    return documents.select("message_title", "message_body", "doc_source", "doc_source_pdf_url", "document_id")


@query(
    "site_link_counts",
    f"""
    SELECT replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '.', '_') AS folder, count(DISTINCT raw) AS n
    FROM ({PAGE_LINKS_SQL}) WHERE raw <> '' GROUP BY 1""",
)
def site_link_counts(spark, sf):
    """Links resolved, first seen per site, counted."""
    links = resolve_links(X.extract_links(pages(spark, sf)), F.col("url")).withColumns(
        {"folder": U.site_folder(F.col("url")), "path": U.path_of(F.col("target"))}
    )
    return count_by(first_seen(links, ["path"], ["folder"], ["page_id", "pos"]), ["folder"])


FDA_RULE = rules.RELEASE_RULES["fda"]._replace(root=ROOT, master_url=MASTER, body="first")


def listing_pages(spark, sf):
    return order_pages(spark, sf).select("seq", "html")


def release_pages(spark, sf):
    """A release page per customer, under the addresses their documents are listed at."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit(f"{ROOT}/docs/"), F.col("c_custkey").cast("string"), F.lit(".pdf")).alias("url"),
        F.concat(F.lit("<article><p>Body &amp; text of "), "c_name", F.lit("<p>More</article>")).alias("html"),
    )


RELEASES_SQL = f"""
    SELECT o_orderkey, 'Release & order ' || o_orderkey AS message_title, 'Body & text of ' || c_name AS message_body,
           '{ROOT}' || href AS doc_source_pdf_url, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS time_master
    FROM (SELECT *, {derived.order_link()} AS href FROM orders) JOIN customer
      ON href = '/docs/' || c_custkey || '.pdf'"""
RELEASE_COLUMNS = ["message_title", "message_body", "doc_source", "doc_source_pdf_url", "time_master", "document_id"]


def documents_sql(source: str, master: str, rows: str) -> str:
    """Records of a source with its constants and their id."""
    _, kind, name, _, _ = next(s for s in rules.SOURCES if s[0] == source)
    message = (
        f"message_title || message_body || '{kind}' || '{name}' || '{master}' || doc_source_pdf_url || time_master || time_master"
    )
    return f"""
    SELECT message_title, message_body, '{name}' AS doc_source, doc_source_pdf_url, time_master,
           {sql_keyed_id(message)} AS document_id
    FROM ({rows})"""


@query("release_documents", documents_sql("fda", MASTER, RELEASES_SQL))
def release_documents(spark, sf):
    """Table listing, release pages, source constants, ids."""
    documents, _ = releases.release_documents(
        listing_pages(spark, sf), release_pages(spark, sf), FDA_RULE, DEMO_KEY
    )
    return documents.select(*RELEASE_COLUMNS)


@query(
    "live_release_documents",
    documents_sql(
        "fda",
        MASTER,
        f"SELECT * FROM ({RELEASES_SQL}) WHERE o_orderkey < (SELECT min(o_orderkey) FROM orders WHERE o_totalprice > 499000)",
    ),
)
def live_release_documents(spark, sf):
    """Only releases listed in front of the first one already held."""
    held = table(spark, sf, "orders").where("o_totalprice > 499000")
    index = held.select(
        F.lit("fda").alias("source"),
        F.concat(F.lit("Release & order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderkey").alias("seq"),
    )
    marks = high_water(index, ["source"], "title", ["seq"])
    documents, _ = releases.release_documents(
        listing_pages(spark, sf), release_pages(spark, sf), FDA_RULE, DEMO_KEY, marks
    )
    return documents.select(*RELEASE_COLUMNS)


@query(
    "card_release_documents",
    documents_sql(
        "hhs",
        rules.RELEASE_RULES["hhs"].master_url,
        f"""SELECT 'Case ' || o_orderpriority AS message_title, 'Paid $' || o_custkey || '.' AS message_body,
                   'https://oig.hhs.gov{derived.HHS_PATH}' || o_orderkey AS doc_source_pdf_url,
                   CASE WHEN o_orderkey = 7 THEN '2010-03-25T00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00') END AS time_master
            FROM orders WHERE o_orderstatus <> 'P'""",
    ),
)
def card_release_documents(spark, sf):
    """Card listing; dates from the release pages, incomplete ones repaired; pages without the article drop out."""
    documents, _ = releases.release_documents(
        derived.card_listing(spark, sf), derived.card_pages(spark, sf), rules.RELEASE_RULES["hhs"], DEMO_KEY
    )
    return documents.select(*RELEASE_COLUMNS)


@query(
    "release_rejects",
    f"""
    SELECT 'Case ' || o_orderpriority AS title, 'https://oig.hhs.gov{derived.HHS_PATH}' || o_orderkey AS link,
           'no release page' AS reason FROM orders WHERE o_orderstatus = 'P'""",
)
def release_rejects(spark, sf):
    """Listed releases whose page lacks the article come back as rejects."""
    _, rejects = releases.release_documents(
        derived.card_listing(spark, sf), derived.card_pages(spark, sf), rules.RELEASE_RULES["hhs"], DEMO_KEY
    )
    return rejects.select("title", "link", "reason")


@query(
    "teaser_release_documents",
    documents_sql(
        "dol",
        rules.RELEASE_RULES["dol"].master_url,
        f"""SELECT 'Release ' || o_orderkey AS message_title, 'By ' || o_custkey || ' for ' || o_orderpriority AS message_body,
                   'https://www.dol.gov{derived.DOL_PATH}' || o_orderkey AS doc_source_pdf_url,
                   strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS time_master FROM orders""",
    ),
)
def teaser_release_documents(spark, sf):
    """Teaser listing with padded links; bodies cut at their marker."""
    documents, _ = releases.release_documents(
        derived.teaser_listing(spark, sf), derived.teaser_pages(spark, sf), rules.RELEASE_RULES["dol"], DEMO_KEY
    )
    return documents.select(*RELEASE_COLUMNS)


DENIED = ("litigation", "exact", "/litigation/litreleases/lr7.htm")
NAMED_SQL = f"""
    SELECT *, CASE WHEN route = 'page_text' THEN parent || '.txt' WHEN route = 'text_file' THEN plain
                   WHEN parent IS NULL THEN plain ELSE parent || ' ' || plain END AS file_name,
           'www_agency_example ' || CASE site WHEN 'enforce' THEN 'Enforce' ELSE site END AS folder
    FROM (SELECT *, last_value(CASE WHEN route = 'page_text' THEN 'lr' || seq END IGNORE NULLS)
                      OVER (PARTITION BY site ORDER BY seq) AS parent,
                 CASE WHEN href LIKE '/files/%' THEN 'note ' || o_custkey || '.txt'
                      WHEN href LIKE 'http%' THEN 'a+b ' || o_custkey || '.pdf' ELSE o_custkey || '.pdf' END AS plain
          FROM (SELECT *, CASE WHEN href LIKE '%.htm' AND site <> 'admin' THEN 'page_text' WHEN href LIKE '%.txt' THEN 'text_file'
                               WHEN href LIKE 'http%.pdf' THEN 'pdf_absolute' WHEN href LIKE '%.pdf' THEN 'pdf_relative' END AS route
                FROM (SELECT {derived.ROUTED_SITE.replace("o_orderpriority", "source")} AS site, * FROM ({LINKS_SQL}))
                WHERE (site <> 'litigation' OR href <> '{DENIED[2]}') AND (site <> 'enforce' OR year >= 1999))
          WHERE route IS NOT NULL)"""


def agency_sites(spark):
    """The routed sites moved to one example host."""
    return rules.local_frame(spark, [(s, ROOT, *rest) for s, _, *rest in rules.ROUTED_SITES], rules.ROUTED_SCHEMA)


def archive_targets(spark, sf):
    """Archive pages to the files not held; notes of urgent orders of the first site are."""
    held = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    manifest = held.select(
        F.lit("www_agency_example litigation").alias("folder"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("note "), F.col("o_custkey").cast("string"), F.lit(".txt")).alias("file_name"),
    )
    denied = rules.local_frame(spark, [*rules.DENIED_LINKS, DENIED], rules.DENY_SCHEMA)
    pages_ = derived.archive_pages(spark, sf)
    return collection.targets_to_fetch(pages_, agency_sites(spark), rules.year_rules(spark), denied, manifest)


@query(
    "files_to_fetch",
    f"""
    WITH named AS ({NAMED_SQL})
    SELECT folder, year, file_name, arg_min(route, seq) AS route, min(seq) AS seq FROM named
    WHERE route <> 'page_text' AND (folder, year, file_name) NOT IN
      (SELECT folder, year, plain FROM named WHERE route = 'text_file' AND source = '1-URGENT')
    GROUP BY folder, year, file_name
    UNION ALL
    SELECT folder, year, file_name, route, seq FROM named WHERE route = 'page_text'""",
)
def files_to_fetch(spark, sf):
    """Linked, routed, named after their parent page, first of each place, not held."""
    return archive_targets(spark, sf).select("folder", "year", "file_name", "route", "seq")


@query(
    "page_text_files",
    f"""
    WITH named AS ({NAMED_SQL})
    SELECT folder, year, file_name, 'Text & order ' || seq || ' see ' || chr(10) || source || chr(10) AS text
    FROM named WHERE route = 'page_text'""",
)
def page_text_files(spark, sf):
    """Texts of the linked pages: one line per text region, cut at the page's own address."""
    pages_ = derived.archived_texts(spark, sf)
    texts = collection.page_texts(archive_targets(spark, sf), pages_, rules.year_rules(spark), agency_sites(spark))
    return texts.select("folder", "year", "file_name", "text")


@query(
    "rule_driven_files",
    f"""
    SELECT folder, year, file_name, min(seq) AS seq FROM (
      SELECT site, CASE site WHEN 'ams' THEN 'www_ams_usda_gov' WHEN 'fcc' THEN 'www_fcc_gov' WHEN 'treasury' THEN 'ofac_treasury_gov'
                       WHEN 'railroads' THEN 'railroads_dot_gov' ELSE 'assets_pcaobus_org' END AS folder,
             CASE WHEN site IN ('fcc', 'treasury') THEN year END AS year, seq, o_custkey,
             CASE site WHEN 'ams' THEN 'My File' WHEN 'railroads' THEN 'f ' WHEN 'pcaob' THEN 'f' ELSE '' END || o_custkey || '.pdf' AS file_name
      FROM (SELECT {derived.RULED_SITE} AS site, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS seq, o_custkey FROM orders)
    )
    WHERE NOT (site = 'ams' AND o_custkey IN
               (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998))
      AND file_name NOT LIKE '%9.pdf'
    GROUP BY folder, year, file_name""",
)
def rule_driven_files(spark, sf):
    """Five sites with their own rules in one job; files of one site are held, one ending is denied, folders
    per year are kept where the site has them."""
    held = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998")
    manifest = held.select(
        F.lit("www_ams_usda_gov").alias("folder"),
        F.lit(None).cast("int").alias("year"),
        F.concat(F.lit("My File"), F.col("o_custkey").cast("string"), F.lit(".pdf")).alias("file_name"),
    )
    endings = {"fcc": "9.pdf", "pcaob": "9.pdf?sfvrsn=1", "railroads": "9/download", "ams": "9.pdf", "treasury": "9/download?inline"}
    denied = rules.local_frame(spark, [(s, "ending", e) for s, e in endings.items()], rules.DENY_SCHEMA)
    files = collection.site_files_to_fetch(
        derived.ruled_pages(spark, sf), rules.site_rules(spark), rules.year_rules(spark), denied, manifest
    )
    return files.select("folder", "year", "file_name", "seq")


PENALTY_SQL = f"""
    SELECT doc, year, table_no, record_no, string_agg(violation, '' ORDER BY row_no, l_partkey) AS summary,
           string_agg(regulation, '' ORDER BY row_no, l_partkey) AS tags, max(name) AS name, max(CASE WHEN name IS NOT NULL THEN number END) AS number,
           max(CASE WHEN name IS NOT NULL THEN payment END) AS payment
    FROM (SELECT *, coalesce(count(name) OVER (PARTITION BY doc, year, table_no ORDER BY row_no, l_partkey
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record_no
          FROM (SELECT l_suppkey AS doc, CAST(year(l_shipdate) AS INTEGER) AS year, l_linenumber AS table_no, l_orderkey AS row_no, l_partkey,
                       CASE l_returnflag WHEN 'A' THEN 'Late report ' WHEN 'R' THEN 'Part ' || l_partkey || ' missing; ' END AS violation,
                       CASE l_returnflag WHEN 'A' THEN '30 CFR ' || l_suppkey || ' ' WHEN 'R' THEN '30 CFR 1241 ' END AS regulation,
                       CASE WHEN l_linestatus = 'F' THEN 'Company ' || l_orderkey END AS name,
                       'CP-' || l_orderkey || '-' || l_linenumber AS number,
                       CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'n/a'
                            ELSE '$' || l_orderkey || ',' || l_linenumber || '00.00' END AS payment
                FROM lineitem))
    GROUP BY doc, year, table_no, record_no HAVING max(name) IS NOT NULL"""


@query(
    "penalty_records",
    f"""
    SELECT doc, table_no, record_no, 'PENALTY COLLECTIONS FY ' || year AS message_title, name AS entity_full_name,
           number AS message_id, coalesce(summary, '') AS message_summary, coalesce(tags, '') AS message_tags,
           CAST(regexp_replace(payment, '[^0-9]', '', 'g') AS BIGINT) AS message_value,
           year || '-12-31T00:00:00.000Z' AS time_master, 'department of interior, office of natural resources revenue' AS doc_source
    FROM ({PENALTY_SQL}) WHERE payment <> 'n/a'""",
)
def penalty_records(spark, sf):
    """Table rows assembled into typed penalty records."""
    records, _ = penalties.penalty_records(derived.penalty_rows(spark, sf), order=("row_no", "l_partkey"))
    return records.select(
        "doc", "table_no", "record_no", "message_title", "entity_full_name", "message_id", "message_summary",
        "message_tags", "message_value", "time_master", "doc_source",
    )


@query(
    "penalty_rejects",
    f"SELECT doc, year, table_no, record_no, 'no amount' AS reason FROM ({PENALTY_SQL}) WHERE payment = 'n/a'",
)
def penalty_rejects(spark, sf):
    _, rejects = penalties.penalty_records(derived.penalty_rows(spark, sf), order=("row_no", "l_partkey"))
    return rejects.select("doc", "year", "table_no", "record_no", "reason")
