"""Queries over fetched pages and their markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regmill.functions import html as H
from regmill.operators import extract as X
from regmill.operators.frontier import code_list
from regmill.operators.regions import scoped_regions
from regmill.plans.catalog import derived
from regmill.plans.catalog.registry import (
    query,
    sql_content,
    sql_decode,
    sql_paragraphs,
    sql_plain,
    sql_strip,
    table,
)
from regmill.sources.readers import scan_pages

PAGE_LINKS_SQL = f"""
    SELECT page_id, url, unnest(range(len(found))) AS pos, unnest(found) AS raw
    FROM (SELECT page_id, url, regexp_extract_all({sql_content()}, '<a href="([^"]*)"', 1) AS found FROM pages)"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return scan_pages(spark, f"{sf}/pages.parquet")


@query("page_scan", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages WHERE html IS NOT NULL")
def page_scan(spark, sf):
    return pages(spark, sf).select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query(
    "page_links",
    f"SELECT page_id, CAST(pos AS BIGINT) AS pos, {sql_decode('raw')} AS href FROM ({PAGE_LINKS_SQL}) WHERE raw <> ''",
)
def page_links(spark, sf):
    links = X.extract_links(pages(spark, sf))
    return links.select("page_id", F.col("pos").cast("bigint"), "href")


@query(
    "links_in_first_tag",
    f"""
    SELECT page_id, CAST(unnest(range(len(found))) AS BIGINT) AS pos, {sql_decode("unnest(found)")} AS href
    FROM (SELECT page_id, regexp_extract_all(
              regexp_extract({sql_content()}, '(?is)<nav>(.*?)</nav>', 1), '<a href="([^"]+)"', 1) AS found FROM pages)""",
)
def links_in_first_tag(spark, sf):
    links = X.extract_links(X.tag_region(pages(spark, sf), "nav"))
    return links.select("page_id", F.col("pos").cast("bigint"), "href")


@query(
    "class_regions",
    f"""
    SELECT page_id, CAST(0 AS BIGINT) AS region_no,
           {sql_plain("regexp_extract(" + sql_content() + ", '(?is)<div class=" + '"ad"' + ">(.*?)</div>', 1)")} AS text
    FROM pages WHERE html LIKE '%<div class="ad">%'""",
)
def class_regions(spark, sf):
    scoped = pages(spark, sf).select("page_id", "html", F.lit("div.ad").alias("scope"))
    return scoped_regions(scoped).select("page_id", "region_no", H.plain(F.col("region")).alias("text"))


@query(
    "nested_scope_links",
    f"""
    SELECT page_id, CAST(i AS BIGINT) AS region_no, {sql_decode('href')} AS href FROM (
      SELECT page_id, unnest(range(len(items))) AS i,
             unnest([regexp_extract(x, '<a href="([^"]*)"', 1) for x in items]) AS href
      FROM (SELECT page_id, regexp_extract_all(regexp_extract({sql_content()}, '(?is)<nav>(.*?)</nav>', 1),
                                               '(?is)<li>(.*?)</li>', 1) AS items FROM pages))
    WHERE href <> ''""",
)
def nested_scope_links(spark, sf):
    """Every item of the first navigation list, then the first link of each."""
    scoped = pages(spark, sf).select("page_id", "html", F.lit("nav > all li").alias("scope"))
    links = X.first_link(scoped_regions(scoped), html="region")
    return links.select("page_id", "region_no", "href")


@query(
    "ordinal_regions",
    f"""
    SELECT page_id, {sql_plain("items[len(items)]")} AS last_item, {sql_plain("items[len(items) - 1]")} AS second_last
    FROM (SELECT page_id, regexp_extract_all({sql_content()}, '(?is)<li>(.*?)</li>', 1) AS items FROM pages)""",
)
def ordinal_regions(spark, sf):
    both = X.nth_region(X.nth_region(pages(spark, sf), "li", F.lit(-1), "a"), "li", F.lit(-2), "b")
    return both.select("page_id", H.plain(F.col("a")).alias("last_item"), H.plain(F.col("b")).alias("second_last"))


@query(
    "first_item_and_link",
    f"""
    SELECT page_id, {sql_plain("regexp_extract(c, '(?is)<li>(.*?)</li>', 1)")} AS first_item,
           {sql_decode("regexp_extract(c, '<a href=" + '"([^"]*)"' + "', 1)")} AS href
    FROM (SELECT page_id, {sql_content()} AS c FROM pages)
    WHERE regexp_extract(c, '<a href="([^"]*)"', 1) <> ''""",
)
def first_item_and_link(spark, sf):
    first = X.first_link(X.first_region(pages(spark, sf), "li"))
    return first.select("page_id", H.plain(F.col("region")).alias("first_item"), "href")


@query(
    "listing_cards",
    f"""
    SELECT page_id, CAST(i AS BIGINT) AS pos, title, 'https://www.agency.example' || href AS link FROM (
      SELECT page_id, i, {sql_strip(sql_plain("regexp_extract(item, '(?is)<a[^>]*>(.*?)</a>', 1)"))} AS title,
             {sql_decode("regexp_extract(item, '<a href=" + '"([^"]*)"' + "', 1)")} AS href, item
      FROM (SELECT page_id, unnest(range(len(items))) AS i, unnest(items) AS item
            FROM (SELECT page_id, regexp_extract_all({sql_content()}, '(?is)<li>(.*?)</li>', 1) AS items FROM pages)))
    WHERE item LIKE '%<a href=%'""",
)
def listing_cards(spark, sf):
    rows = X.extract_listing(pages(spark, sf), "cards", derived.ROOT)
    return rows.select("page_id", F.col("pos").cast("bigint"), "title", "link")


@query(
    "listing_table",
    f"""
    SELECT seq, CAST(0 AS BIGINT) AS pos, day AS date, title, '{derived.ROOT}' || href AS link FROM (
      SELECT o_orderkey AS seq, CAST(month(o_orderdate) AS VARCHAR) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS day,
             'Release & order ' || o_orderkey AS title, {derived.order_link()} AS href FROM orders)""",
)
def listing_table(spark, sf):
    rows = X.extract_listing(derived.order_pages(spark, sf), "table", derived.ROOT)
    return rows.select("seq", F.col("pos").cast("bigint"), "date", "title", "link")


@query(
    "table_cells",
    """
    SELECT o_orderkey AS seq, CAST(r AS BIGINT) AS row_no, CAST(c AS BIGINT) AS cell_no, cell FROM (
      SELECT o_orderkey, 0 AS r, 0 AS c,
             CAST(month(o_orderdate) AS VARCHAR) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS cell FROM orders
      UNION ALL SELECT o_orderkey, 0, 1, 'Release & order ' || o_orderkey FROM orders
      UNION ALL SELECT o_orderkey, 1, 0, o_orderstatus FROM orders
      UNION ALL SELECT o_orderkey, 1, 1, o_orderpriority FROM orders
      UNION ALL SELECT o_orderkey, 1, 2, '' FROM orders)""",
)
def table_cells(spark, sf):
    rows = X.extract_table(derived.order_pages(spark, sf))
    return rows.select(
        "seq", F.col("row_no").cast("bigint"), F.posexplode("cells").alias("cell_no", "cell")
    ).withColumn("cell_no", F.col("cell_no").cast("bigint"))


@query(
    "document_table_cells",
    f"""
    SELECT doc_id, CAST(r AS BIGINT) AS row_no, CAST(unnest(range(len(cells))) AS BIGINT) AS cell_no,
           {sql_strip("unnest(cells)")} AS cell
    FROM (SELECT doc_id, r, string_split(replace(line, '. ', '.' || chr(1)), chr(1)) AS cells
          FROM (SELECT doc_id, unnest(range(len(lines))) AS r, unnest(lines) AS line
                FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)))""",
)
def document_table_cells(spark, sf):
    """Ragged rows over whole documents."""
    rows = X.extract_table(derived.document_tables(spark, sf))
    return rows.select(
        "doc_id", F.col("row_no").cast("bigint"), F.posexplode("cells").alias("cell_no", "cell")
    ).withColumn("cell_no", F.col("cell_no").cast("bigint"))


@query(
    "option_codes",
    """
    SELECT o_orderkey AS seq, CAST(0 AS BIGINT) AS pos, CAST(o_custkey AS VARCHAR) AS code FROM orders
    UNION ALL SELECT o_orderkey, CAST(1 AS BIGINT), o_orderstatus FROM orders""",
)
def option_codes(spark, sf):
    codes = code_list(derived.order_pages(spark, sf), "html")
    return codes.select("seq", F.col("pos").cast("bigint"), "code")


def _body_sql(expr: str) -> str:
    return f"SELECT page_id, {expr} AS body FROM (SELECT page_id, {sql_paragraphs(sql_content())} AS ps FROM pages)"


@query(
    "body_leaf_paragraphs",
    _body_sql(
        "array_to_string([" + sql_plain("p") + " for p in ps if "
        "regexp_matches(p, '(?s)^(?:<[A-Za-z][^>]*>)*([^<]+)(?:</[^>]*>)*$') "
        r"AND NOT regexp_matches(p, '(?i)<(br|hr|img|input|wbr)\b')], '')"
    ),
)
def body_leaf_paragraphs(spark, sf):
    return X.body_text(pages(spark, sf), "leaves").select("page_id", "body")


@query("body_first_paragraph", _body_sql(sql_plain("ps[1]")))
def body_first_paragraph(spark, sf):
    return X.body_text(pages(spark, sf), "first").select("page_id", "body")


@query("body_region_cut", f"SELECT page_id, string_split({sql_plain(sql_content())}, '©')[1] AS body FROM pages")
def body_region_cut(spark, sf):
    return X.body_text(pages(spark, sf), "region", "©").select("page_id", "body")


@query(
    "body_lines_cut",
    _body_sql(
        "array_to_string([string_split(" + sql_strip(sql_plain("p")) + ", ' and ')[1] || chr(10) for p in ps], '')"
    ),
)
def body_lines_cut(spark, sf):
    return X.body_text(pages(spark, sf), "lines", " and ").select("page_id", "body")


@query(
    "labelled_dates",
    """
    SELECT o_orderkey AS seq, ' ' || strftime(o_orderdate, '%B') || ' ' || day(o_orderdate) || ' ' || year(o_orderdate) AS date
    FROM orders""",
)
def labelled_dates(spark, sf):
    items = X.first_region(derived.order_pages(spark, sf), "li")
    return X.labelled_date(items.withColumn("text", H.plain(F.col("region"))), "text").select("seq", "date")
