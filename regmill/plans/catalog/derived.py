"""Inputs the given tables do not hold as such, written as markup or JSON from their rows.

Every frame here is a projection of a given table (or two joined), so it grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmill.operators.scale import deal_out
from regmill.plans.catalog.registry import shares, table

ROOT = "https://www.agency.example"


def order_link(prefix: str = "") -> str:
    """SQL (both dialects): the link an order stands for; its shape follows status and priority."""
    p = prefix
    return (
        f"CASE WHEN {p}o_orderstatus = 'O' THEN '/litigation/litreleases/lr' || {p}o_orderkey || '.htm'"
        f" WHEN {p}o_orderstatus = 'F' THEN '/files/note%2520' || {p}o_custkey || '.txt'"
        f" WHEN {p}o_orderpriority = '1-URGENT' THEN '{ROOT}/docs/a+b%20' || {p}o_custkey || '.pdf'"
        f" WHEN {p}o_orderpriority = '2-HIGH' THEN '/media/' || {p}o_custkey || '/download?inline'"
        f" ELSE '/docs/' || {p}o_custkey || '.pdf' END"
    )


def order_links(spark: SparkSession, sf: str) -> DataFrame:
    """One listing link per order: source (priority), year, seq (order key), href."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderpriority AS source",
        "year(o_orderdate) AS year",
        "o_orderkey AS seq",
        "o_custkey",
        f"{order_link()} AS href",
    )


LINKS_SQL = f"""
    SELECT o_orderpriority AS source, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS seq, o_custkey,
           {order_link()} AS href
    FROM orders"""


def order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A listing page per order: a script with markup in it, a dated table row, a region and a card."""
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        "o_orderpriority AS site",
        "year(o_orderdate) AS year",
        "o_orderkey AS seq",
        """'<html><script>var t = "<tbody><tr><td>x</td></tr></tbody>";</script><body><div class="view-content"><table><tbody>'
           || '<tr><td>' || date_format(o_orderdate, 'M/d/yyyy') || '</td><td><a href="'"""
        + f" || {order_link()} || "
        + """'">Release &amp; order ' || o_orderkey || '</a></td></tr>'
           || '<tr><td> ' || o_orderstatus || ' </td><td>' || o_orderpriority || '</td><td>&nbsp;</td></tr></tbody></table></div>'
           || '<div><ul><li>Customer ' || o_custkey || ', Date: ' || date_format(o_orderdate, 'MMMM d, yyyy') || ', ' || o_orderpriority || '</li></ul></div>'
           || '<select id="nationality"><option>all</option><option value="' || o_custkey || '">c</option><option value="' || o_orderstatus || '">s</option></select>'
           || '<table><tr><td><a href="/nav.htm">next</a></td></tr></table></body></html>' AS html""",
    )


def month_name(ts: str) -> str:
    return f"strftime({ts}, '%B')"


ROUTED_SITE = (
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'litigation'"
    " WHEN o_orderpriority = '3-MEDIUM' THEN 'admin' ELSE 'enforce' END"
)


def archive_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The order pages as archive pages of the three routed sites."""
    site = F.expr(ROUTED_SITE.replace("o_orderpriority", "site"))
    return order_pages(spark, sf).withColumn("site", site)


def archived_texts(spark: SparkSession, sf: str) -> DataFrame:
    """The page each order's page link points to; its text names its own address."""
    url = f"'{ROOT}/litigation/litreleases/lr' || o_orderkey || '.htm'"
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        f"{ROUTED_SITE} AS site",
        "year(o_orderdate) AS year",
        f"{url} AS url",
        f"""'<body><font> Text &amp; order ' || o_orderkey || ' see http' || substr({url}, 6) || ' now</font>'
            || '<p>aside</p><font>' || o_orderpriority || '</font></body>' AS html""",
    )


RULED_SITE = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'ams' WHEN '2-HIGH' THEN 'fcc' WHEN '3-MEDIUM' THEN 'treasury'"
    " WHEN '4-NOT SPECIFIED' THEN 'railroads' ELSE 'pcaob' END"
)


def ruled_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Listing pages of five sites, one per order, and the pages two of them link to, one per customer."""
    listing = deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        f"{RULED_SITE} AS site",
        "year(o_orderdate) AS year",
        "o_orderkey AS seq",
        "'https://listing.example/' || o_orderkey AS url",
        """CASE o_orderpriority
           WHEN '1-URGENT' THEN '<a href="/reports/My%2520File' || o_custkey || '.pdf">x</a><a href="/other">o</a>'
           WHEN '2-HIGH' THEN '<div class="view-content"><div><a href="/document/' || o_custkey || '">d</a></div><a href="/x">x</a></div><a href="/document/out">n</a>'
           WHEN '3-MEDIUM' THEN '<table><tr><td><a href="https://ofac.treasury.gov/media/' || o_custkey || '/download?inline">m</a></td></tr></table><a href="/media/0/download?inline">o</a>'
           WHEN '4-NOT SPECIFIED' THEN '<h2 class="title elibrary--title"><a href="/elib/' || o_custkey || '">t</a><a href="/elib/second">s</a></h2><a href="/elib/out">o</a>'
           ELSE '<a href="https://assets.pcaobus.org/pcaob-dev/docs/default-source/enforcement/decisions/documents/f' || o_custkey || '.pdf?sfvrsn=1">p</a><a href="/no.pdf">n</a>' END AS html""",
    )
    customers = table(spark, sf, "customer")
    no_place = ["CAST(NULL AS INT) AS year", "CAST(NULL AS BIGINT) AS seq"]
    fcc = customers.selectExpr(
        "'fcc' AS site", *no_place, "'https://www.fcc.gov/document/' || c_custkey AS url",
        """'<div class="documents"><a href="https://www.fcc.gov/f/' || c_custkey || '.pdf">p</a><a href="/f/x.txt">t</a></div><a href="/no.pdf">n</a>' AS html""",
    )
    railroads = customers.selectExpr(
        "'railroads' AS site", *no_place, "'https://railroads.dot.gov/elib/' || c_custkey AS url",
        """'<div class="document--set file--attachment field field--name-field-document field--type-file field--label-hidden clearfix field__item"><a href="/sites/f%20'
           || c_custkey || '/download">p</a><a href="/second/download">t</a></div>' AS html""",
    )
    return listing.unionByName(fcc).unionByName(railroads)


HHS_PATH = "/fraud/enforcement/"
ARTICLE = "grid-col desktop:grid-col-10 margin-bottom-2 desktop:margin-bottom-5"


def card_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A page of two cards per order: one linked, one not; around it, a list outside the region."""
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        "o_orderkey AS seq",
        f"""'<ul class="nav"><li><a href="/x">x</a></li></ul><ul class="usa-card-group padding-y-0"><li><a href="{HHS_PATH}'
           || o_orderkey || '"> Case ' || o_orderpriority || ' </a></li><li>plain</li></ul>' AS html""",
    )


def card_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The release page of each order; those of one status lack the article."""
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        f"'https://oig.hhs.gov{HHS_PATH}' || o_orderkey AS url",
        f"""'<p>menu</p><article class="' || CASE WHEN o_orderstatus = 'P' THEN 'other' ELSE '{ARTICLE}' END
           || '"><ul><li>Date: ' || CASE WHEN o_orderkey = 7 THEN 'March, 2010' ELSE date_format(o_orderdate, 'MMMM d, yyyy') END
           || ', Action</li><li>second</li></ul><p>Paid &#36;' || o_custkey || '.</p><p>More</p></article>' AS html""",
    )


DOL_PATH = "/newsroom/releases/ofccp/"


def teaser_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A page of two teasers per order; the link of the second one is not padded and so not kept."""
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        "o_orderkey AS seq",
        f"""'<div class="image-left-teaser x"><h3> Release ' || o_orderkey || ' </h3><p><span class="dol-date-text"> '
           || date_format(o_orderdate, 'MMMM d, yyyy') || '</span></p><a href="    {DOL_PATH}' || o_orderkey || '  ">more</a></div>'
           || '<div class="image-left-teaser"><h3>Other</h3><a href="{DOL_PATH}0">m</a></div>' AS html""",
    )


def teaser_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The release page of each order, its region nested, text behind the marker to be cut."""
    return deal_out(table(spark, sf, "orders"), "o_orderkey", shares(spark)).selectExpr(
        f"'https://www.dol.gov{DOL_PATH}' || o_orderkey AS url",
        """'<div>menu<div class="dol-press-page"><div>By ' || o_custkey || '</div> for ' || o_orderpriority
           || '<div>Share This page</div></div>footer</div>' AS html""",
    )


def document_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as a table page: a row per line, a cell per sentence end."""
    safe = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
    return deal_out(table(spark, sf, "documents"), "doc_id", shares(spark)).selectExpr(
        "doc_id",
        f"""'<table><tbody><tr><td> ' || replace(replace({safe}, '. ', '.</td><td>'), '\\n', ' </td></tr><tr><td> ')
            || '</td></tr></tbody></table>' AS html""",
    )


def notice_responses(spark: SparkSession, sf: str) -> DataFrame:
    """A search response (JSON text) per customer holding one notice; without a picture in one segment."""
    c = table(spark, sf, "customer")
    notice = F.struct(
        F.concat(F.lit("N/"), F.col("c_custkey").cast("string")).alias("entity_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("forename"),
        F.lit("1900").alias("date_of_birth"),
        F.array(F.col("c_nationkey").cast("string")).alias("nationalities"),
        F.struct(
            F.struct(F.concat(F.lit("/notice/"), F.col("c_custkey").cast("string")).alias("href")).alias("self"),
            F.when(
                F.col("c_mktsegment") != "BUILDING",
                F.struct(F.concat(F.lit("/image/"), F.col("c_custkey").cast("string")).alias("href")),
            ).alias("thumbnail"),
        ).alias("_links"),
    )
    body = F.struct(
        F.lit(1).alias("total"),
        F.struct(F.lit(160).alias("resultPerPage")).alias("query"),
        F.struct(F.array(notice).alias("notices")).alias("_embedded"),
    )
    return c.select(F.to_json(body).alias("response"))


def notice_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail responses (JSON text) by notice URL; absent values differ by customer."""
    c = table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    key = F.col("c_custkey").cast("string")
    year = (F.lit(1940) + F.col("c_nationkey")).cast("string")
    detail = F.struct(
        F.concat(F.lit("N/"), key).alias("entity_id"),
        F.when(seg != "FURNITURE", F.concat(F.lit("D"), F.col("c_name"))).alias("name"),
        F.concat(F.lit("F"), key).alias("forename"),
        F.when(seg == "MACHINERY", year)
        .when(seg == "HOUSEHOLD", F.concat(year, F.lit("/05")))
        .otherwise(F.concat(year, F.lit("/5/03")))
        .alias("date_of_birth"),
        F.when(F.col("c_acctbal") > 0, F.lit("M")).otherwise(F.lit("F")).alias("sex_id"),
        F.col("c_mktsegment").alias("place_of_birth"),
        F.col("c_nationkey").cast("string").alias("country_of_birth_id"),
        F.when(F.col("c_acctbal") > 5000, F.lit("tall")).alias("distinguishing_marks"),
        F.when(F.col("c_acctbal") > 8000, F.col("c_nationkey")).alias("weight"),
        F.when(F.col("c_acctbal") > 2000, F.array(F.lit("BLO"), F.lit("BRO"))).alias("hairs_id"),
        F.when(F.col("c_acctbal") > 9000, F.lit("BLU")).alias("eyes_colors_id"),
        F.array(F.concat(F.lit("L"), F.col("c_nationkey").cast("string"))).alias("languages_spoken_ids"),
        F.array(F.col("c_nationkey").cast("string")).alias("nationalities"),
        F.when(
            seg == "AUTOMOBILE", F.from_json(F.lit("[]"), "array<struct<charge:string,issuing_country_id:string>>")
        )
        .otherwise(
            F.array(
                F.struct(F.concat(F.lit("charge "), key).alias("charge"), F.lit("US").alias("issuing_country_id")),
                F.struct(F.lit("second").alias("charge"), F.lit("FR").alias("issuing_country_id")),
            )
        )
        .alias("arrest_warrants"),
    )
    return c.select(F.concat(F.lit("/notice/"), key).alias("detail_url"), F.to_json(detail).alias("response"))


PENALTY_CITE = (
    "CASE l_returnflag WHEN 'A' THEN 'Late report 30 CFR ' || l_suppkey"
    " WHEN 'R' THEN 'Part ' || l_partkey || ' missing; 30 CFR 1241'"
    " WHEN 'N' THEN 'no citation ' || l_suppkey END"
)


def penalty_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as rows of extracted penalty tables: supplier and year a document, line number its table.

    Rows follow the order key; part numbers part the few that share one.
    """
    rows = table(spark, sf, "lineitem")
    return rows.selectExpr(
        "l_suppkey AS doc",
        "year(l_shipdate) AS year",
        "l_linenumber AS table_no",
        "l_orderkey AS row_no",
        "l_partkey",
        f"{PENALTY_CITE} AS `Violation Regulation(s)`",
        "CASE WHEN l_linestatus = 'F' THEN 'Company ' || l_orderkey END AS `Business Name`",
        "'CP-' || l_orderkey || '-' || l_linenumber AS `Case Number`",
        "CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 'n/a' ELSE '$' || l_orderkey || ',' || l_linenumber || '00.00' END AS `Payments`",
    )
