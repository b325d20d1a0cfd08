"""Queries that choose, route, resolve, name and follow links."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from regmill.functions import urls as U
from regmill.functions.text import cut_before
from regmill.operators import extract as X
from regmill.operators import links as L
from regmill.operators import page_store as P
from regmill.operators.ordered import count_by
from regmill.operators.scale import deal_out
from regmill.operators.store import union_collections
from regmill.plans.catalog.derived import LINKS_SQL, ROOT, order_links
from regmill.plans.catalog.page_queries import PAGE_LINKS_SQL, pages
from regmill.plans.catalog.registry import CORES, query, sql_decode, table
from regmill.rules import local_frame
from regmill.session import fresh_dir, written

PAGE_PREFIX = "/litigation/litreleases"


@query("links_by_ending", f"SELECT seq, href FROM ({LINKS_SQL}) WHERE href LIKE '%.pdf' OR href LIKE '%download?inline'")
def links_by_ending(spark, sf):
    return L.keep_links(order_links(spark, sf), endings=[".pdf", "download?inline"]).select("seq", "href")


@query("links_by_beginning", f"SELECT seq, href FROM ({LINKS_SQL}) WHERE href LIKE '/docs%' OR href LIKE '/files%'")
def links_by_beginning(spark, sf):
    return L.keep_links(order_links(spark, sf), beginnings=["/docs", "/files"]).select("seq", "href")


@query(
    "links_by_site_rules",
    f"""
    SELECT seq, source, href FROM ({LINKS_SQL})
    WHERE CASE source WHEN '1-URGENT' THEN href LIKE '%.pdf' OR href LIKE '%.txt' WHEN '2-HIGH' THEN href LIKE '/media%'
          WHEN '3-MEDIUM' THEN true ELSE false END""",
)
def links_by_site_rules(spark, sf):
    rules = local_frame(
        spark,
        [("1-URGENT", [".pdf", ".txt"], []), ("2-HIGH", [], ["/media"]), ("3-MEDIUM", [], [])],
        "site string, endings array<string>, beginnings array<string>",
    )
    links = order_links(spark, sf).withColumnRenamed("source", "site")
    return L.keep_by_rules(links, rules).select("seq", F.col("site").alias("source"), "href")


@query(
    "padded_releases",
    f"SELECT seq, href FROM ({LINKS_SQL}) WHERE href LIKE '/litigation/%'",
)
def padded_releases(spark, sf):
    padded = order_links(spark, sf).withColumn("href", F.concat(F.lit("    "), "href", F.lit("  \n more")))
    return L.padded_release(padded, "    /litigation/").select("seq", "href")


@query(
    "links_not_denied",
    f"""
    SELECT seq, source, href FROM ({LINKS_SQL}) AS l
    WHERE NOT EXISTS (SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
                      WHERE n_regionkey = 1 AND '/docs/' || c_custkey || '.pdf' = l.href)
      AND href NOT LIKE '%7.htm'""",
)
def links_not_denied(spark, sf):
    """Exact deny-list (documents of the customers of one region, and a null entry) and a denied ending."""
    nations = table(spark, sf, "nation").where("n_regionkey = 1")
    held = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    denied = held.select(F.concat(F.lit("/docs/"), F.col("c_custkey"), F.lit(".pdf")).alias("value"))
    denied = denied.unionByName(local_frame(spark, [(None,)], "value string"))
    kept = L.deny_links(order_links(spark, sf), denied, by=[])
    return L.deny_endings(kept, ["7.htm"]).select("seq", "source", "href")


ROUTE_SQL = f"""
    SELECT *, CASE WHEN href LIKE '%.htm' AND href LIKE '{PAGE_PREFIX}%' THEN 'page_text'
                   WHEN href LIKE '%.txt' THEN 'text_file'
                   WHEN href LIKE '{ROOT}%.pdf' THEN 'pdf_absolute'
                   WHEN href LIKE '%.pdf' THEN 'pdf_relative' END AS route
    FROM ({LINKS_SQL})"""


@query("link_routes", f"SELECT seq, href, route FROM ({ROUTE_SQL}) WHERE route IS NOT NULL")
def link_routes(spark, sf):
    return L.route_links(order_links(spark, sf), ROOT, PAGE_PREFIX).select("seq", "href", "route")


@query(
    "route_counts",
    f"SELECT source, route, count(*) AS n FROM ({ROUTE_SQL}) WHERE route IS NOT NULL GROUP BY source, route",
)
def route_counts(spark, sf):
    return count_by(L.route_links(order_links(spark, sf), ROOT, PAGE_PREFIX), ["source", "route"])


@query(
    "filing_window",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-12-31' AND o_orderdate < TIMESTAMP '1999-01-01'""",
)
def filing_window(spark, sf):
    """The calendar year between the two bounds."""
    filings = table(spark, sf, "orders")
    return L.filings_between(filings, "1997-12-31", "1999-01-01", "o_orderdate").select("o_orderkey", "o_custkey")


@query(
    "filing_outcomes",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'error' WHEN coalesce(n, 0) = 0 THEN 'no files' ELSE 'files' END AS outcome,
           coalesce(n, 0) AS n_files
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
)
def filing_outcomes(spark, sf):
    counts = count_by(table(spark, sf, "orders"), ["o_custkey"])
    per_ticker = table(spark, sf, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    marked = per_ticker.withColumns(
        {"n_files": F.coalesce("n", F.lit(0).cast("bigint")), "failed": F.col("c_acctbal") < 0}
    )
    return L.classify(marked).select("c_custkey", "outcome", "n_files")


@query(
    "downloaded_or_held",
    f"""
    SELECT CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
                THEN 'already held' ELSE 'downloaded' END AS outcome, count(*) AS n
    FROM ({LINKS_SQL}) GROUP BY 1""",
)
def downloaded_or_held(spark, sf):
    held = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return count_by(L.held_or_new(order_links(spark, sf), held, ["o_custkey"]), ["outcome"])


# A listing per event points at the page whose number its JSON names: many links, few pages.
EVENT_TARGET_SQL = """
    SELECT event_id, user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events"""


def event_links(spark, sf):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf, "events").select(
        "event_id", "user_id", F.concat(F.lit("/p/"), k).alias("target")
    )


def numbered_pages(spark, sf):
    """Pages under a path built from their number."""
    return pages(spark, sf).select(F.concat(F.lit("/p/"), F.col("page_id").cast("string")).alias("url"), "html")


FOLLOWED_SQL = f"""
    SELECT '/p/' || k AS target, first_event, n_refs, CAST(pos AS BIGINT) AS pos, {sql_decode('raw')} AS href
    FROM (SELECT k, min(event_id) AS first_event, count(*) AS n_refs FROM ({EVENT_TARGET_SQL}) GROUP BY k)
    JOIN ({PAGE_LINKS_SQL}) ON k = page_id WHERE raw <> ''"""


def first_events(found):
    return found.select(
        "target", F.col("first_ref.event_id").alias("first_event"), "n_refs", F.col("pos").cast("bigint"), "href"
    )


@query("followed_links", FOLLOWED_SQL)
def followed_links(spark, sf):
    return first_events(L.follow(event_links(spark, sf), numbered_pages(spark, sf), ["event_id"]))


@query("followed_links_by_bucket", FOLLOWED_SQL)
def followed_links_by_bucket(spark, sf):
    """The same over pages stored in buckets by their address."""
    name = f"pages_{uuid.uuid4().hex}"
    store = P.write_pages(numbered_pages(spark, sf), name, CORES, path=fresh_dir(spark, name))
    return first_events(P.follow(spark, event_links(spark, sf), store, ["event_id"]))


@query(
    "links_without_page",
    f"""
    SELECT '/p/' || (k * 7) AS target, count(*) AS n_refs FROM ({EVENT_TARGET_SQL})
    WHERE k * 7 NOT IN (SELECT page_id FROM pages) GROUP BY 1""",
)
def links_without_page(spark, sf):
    k = (F.get_json_object("props", "$.k").cast("bigint") * 7).cast("string")
    links = table(spark, sf, "events").select(F.concat(F.lit("/p/"), k).alias("target"))
    return L.unmatched(links, numbered_pages(spark, sf))


NOT_HELD_SQL = f"""
    SELECT source, year, href, min(seq) AS seq FROM ({LINKS_SQL})
    WHERE (source, year, href) NOT IN (
      SELECT source, year, href FROM ({LINKS_SQL}) JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
    GROUP BY source, year, href"""


def links_and_manifest(spark, sf):
    links = order_links(spark, sf)
    holders = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return links, links.join(holders, F.col("o_custkey") == F.col("c_custkey"))


@query("targets_not_held", NOT_HELD_SQL)
def targets_not_held(spark, sf):
    """First target of each place in the batch, without the places customers of one segment hold already."""
    links, manifest = links_and_manifest(spark, sf)
    return L.not_held(links, manifest, ["source", "year", "href"], ["seq"]).select("source", "year", "href", "seq")


@query("targets_not_held_filtered", NOT_HELD_SQL)
def targets_not_held_filtered(spark, sf):
    """The same through a Bloom filter of the manifest, which has been written as a store has it."""
    links, manifest = links_and_manifest(spark, sf)
    place = ["source", "year", "href"]
    held = written(manifest.select(*place), "held-places")
    return L.not_held_filtered(links, held, place, ["seq"]).select("source", "year", "href", "seq")


@query(
    "collections_union",
    f"""
    SELECT kind, href, count(*) AS n FROM (
      SELECT 'current' AS kind, href FROM ({LINKS_SQL}) UNION ALL
      SELECT 'archive', {sql_decode('raw')} FROM ({PAGE_LINKS_SQL}) WHERE raw <> '')
    GROUP BY kind, href""",
)
def collections_union(spark, sf):
    current = order_links(spark, sf).select(F.lit("current").alias("kind"), "href")
    archive = X.extract_links(pages(spark, sf)).select(F.lit("archive").alias("kind"), "href")
    return count_by(union_collections(current, archive), ["kind", "href"])


@query(
    "resolved_links",
    f"""
    SELECT page_id, CAST(pos AS BIGINT) AS pos, regexp_extract(url, '^(https?://[^/?#]*)', 1) || {sql_decode('raw')} AS target
    FROM ({PAGE_LINKS_SQL}) WHERE raw <> ''""",
)
def resolved_links(spark, sf):
    links = L.resolve_links(X.extract_links(pages(spark, sf)), F.col("url"))
    return links.select("page_id", F.col("pos").cast("bigint"), "target")


@query(
    "resolved_relative_links",
    """
    SELECT page_id, origin || folder || name AS sibling, regexp_extract(url, '^([^?#]*)', 1) || '?q=1' AS with_query,
           regexp_extract(url, '^([^#]*)', 1) || '#f' AS with_fragment, regexp_extract(url, '^([a-z]+:)', 1) || '//other.example/x' AS other_host,
           origin || regexp_replace(folder, '[^/]+/$', '') || 'up.pdf' AS parent
    FROM (SELECT page_id, url, CAST(page_id AS VARCHAR) || '.pdf' AS name, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin,
                 regexp_extract(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '^(.*/)', 1) AS folder
          FROM pages)""",
)
def resolved_relative_links(spark, sf):
    """Every other shape of reference against each page's own address."""
    base = F.col("url")
    return pages(spark, sf).select(
        "page_id",
        U.resolve(base, F.concat(F.col("page_id").cast("string"), F.lit(".pdf"))).alias("sibling"),
        U.resolve(base, F.lit("?q=1")).alias("with_query"),
        U.resolve(base, F.lit("#f")).alias("with_fragment"),
        U.resolve(base, F.lit("//other.example/x")).alias("other_host"),
        U.resolve(base, F.lit("../up.pdf")).alias("parent"),
    )


@query(
    "links_without_base",
    f"SELECT seq, CASE WHEN href LIKE '{ROOT}%' THEN substr(href, {len(ROOT) + 1}) ELSE href END AS href FROM ({LINKS_SQL})",
)
def links_without_base(spark, sf):
    return order_links(spark, sf).select("seq", U.without_base(F.col("href"), F.lit(ROOT)).alias("href"))


@query(
    "target_names",
    f"""
    SELECT seq, CASE
        WHEN href LIKE '%.htm' THEN 'lr' || seq || '.htm'
        WHEN href LIKE '/files/%' THEN 'note ' || o_custkey || '.txt'
        WHEN href LIKE 'http%' THEN 'a+b ' || o_custkey || '.pdf'
        ELSE o_custkey || '.pdf' END AS file_name
    FROM ({LINKS_SQL})""",
)
def target_names(spark, sf):
    """Decoded base names; media downloads by their number."""
    links = order_links(spark, sf)
    rule = F.when(F.endswith("href", F.lit("download?inline")), "media").otherwise("base")
    named = L.name_targets(links, rule, "href")
    return named.select("seq", "file_name")


@query(
    "page_names",
    """
    SELECT page_id, url_decode(url_decode(string_split(string_split(url, '?')[1], '/')[-1])) AS without_query,
           CASE WHEN dl LIKE '%.pdf' THEN dl ELSE dl || '.pdf' END AS download_name, string_split(url, 'ref=')[-1] || '.pdf' AS by_id
    FROM (SELECT page_id, url, url_decode(url_decode(string_split(url, '/')[-1])) AS dl FROM pages)""",
)
def page_names(spark, sf):
    url = F.col("url")
    shifted = F.replace(url, F.lit("ref="), F.lit("id="))
    return pages(spark, sf).select(
        "page_id",
        U.file_name(url, F.lit("noq")).alias("without_query"),
        U.file_name(F.concat(url, F.lit("/download")), F.lit("dl")).alias("download_name"),
        F.replace(U.file_name(shifted, F.lit("id")), F.lit("id="), F.lit("ref=")).alias("by_id"),
    )


@query(
    "decoded_names",
    """
    SELECT doc_id, text AS name FROM documents""",
)
def decoded_names(spark, sf):
    """Texts percent-encoded twice come back whole."""
    once = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    twice = F.replace(F.url_encode(once), F.lit("+"), F.lit("%20"))
    documents = deal_out(table(spark, sf, "documents"), "doc_id", CORES)
    return documents.select("doc_id", U.twice_decoded(twice).alias("name"))


@query(
    "site_folders",
    """
    SELECT replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '.', '_') || '_Audits' AS folder, count(*) AS n
    FROM pages GROUP BY 1""",
)
def site_folders(spark, sf):
    return count_by(pages(spark, sf).select(U.site_folder(F.col("url"), "_Audits").alias("folder")), ["folder"])


@query(
    "texts_cut_at_self",
    """
    SELECT page_id, regexp_replace(url, '^https://', 'http://') AS plain_url,
           string_split(html || ' ' || regexp_replace(url, '^https://', 'http://') || ' end', regexp_replace(url, '^https://', 'http://'))[1] AS text
    FROM pages""",
)
def texts_cut_at_self(spark, sf):
    """Scheme swapped once; page text cut where it names its own address."""
    own = F.regexp_replace("url", "^https://", "http://")
    named = pages(spark, sf).withColumns({"plain_url": own, "text": F.concat("html", F.lit(" "), own, F.lit(" end"))})
    return named.select("page_id", "plain_url", cut_before(F.col("text"), F.col("plain_url")).alias("text"))


