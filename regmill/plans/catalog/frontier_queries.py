"""Queries that generate the addresses to visit."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmill import rules
from regmill.operators import frontier as O
from regmill.operators.ordered import count_by
from regmill.operators.quota import quota_remainder, quota_split, unknown_sex_leaf
from regmill.plans.catalog.registry import query, table

AS_OF = 2000


def customer_years(spark, sf):
    """A yearly frontier per customer: first to last order year."""
    orders = table(spark, sf, "orders")
    return orders.groupBy(F.col("o_custkey").alias("site")).agg(
        F.min(F.year("o_orderdate")).alias("year_lo"), F.max(F.year("o_orderdate")).alias("year_hi")
    )


CUSTOMER_YEARS_SQL = """
    SELECT o_custkey AS site, CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi
    FROM orders GROUP BY o_custkey"""


@query(
    "year_frontier",
    f"""
    SELECT site, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS year FROM ({CUSTOMER_YEARS_SQL})""",
)
def year_frontier(spark, sf):
    return O.expand_years(customer_years(spark, sf), AS_OF).select("site", "year")


@query(
    "year_frontier_to_current",
    f"""
    SELECT site, CAST(unnest(range(lo, {AS_OF})) AS INTEGER) AS year FROM ({CUSTOMER_YEARS_SQL})""",
)
def year_frontier_to_current(spark, sf):
    """Up to the year before the current one: empty for customers who started later."""
    rules_now = customer_years(spark, sf).withColumn("year_hi", F.lit(-1))
    return O.expand_years(rules_now, AS_OF).select("site", "year")


def _year_rule_sql() -> str:
    rows = ", ".join(
        "("
        + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row)
        + ")"
        for row in rules.YEAR_RULES
    )
    return f"(VALUES {rows}) AS r(site, year_lo, year_hi, template, scope, text_scope)"


@query(
    "year_rules",
    f"""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, site,
           replace(template, '{{year}}', CAST(year(o_orderdate) AS VARCHAR)) AS address,
           scope, text_scope
    FROM orders JOIN {_year_rule_sql()}
      ON r.site = CASE o_orderstatus WHEN 'O' THEN 'litigation' WHEN 'F' THEN 'admin' ELSE 'enforce' END
     AND year(o_orderdate) BETWEEN year_lo AND coalesce(year_hi, year(o_orderdate))""",
)
def year_rules(spark, sf):
    """Address and region of each order's year; the third site has no rule before 1999."""
    site = (
        F.when(F.col("o_orderstatus") == "O", "litigation").when(F.col("o_orderstatus") == "F", "admin").otherwise("enforce")
    )
    dated = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), site.alias("site"))
    out = O.apply_year_rules(dated, rules.year_rules(spark))
    return out.select("o_orderkey", "year", "site", F.col("template").alias("address"), "scope", "text_scope")


@query(
    "letter_frontier",
    """
    SELECT s_name || '/' || chr(CAST(l AS INTEGER)) || '.html' AS address
    FROM supplier, range(97, 123) AS t(l)""",
)
def letter_frontier(spark, sf):
    """Category by letter: the supplier name is the category."""
    pairs = O.cross_frontier(table(spark, sf, "supplier").select("s_name"), letter=O.letters())
    return pairs.select(F.concat("s_name", F.lit("/"), "letter", F.lit(".html")).alias("address"))


@query(
    "category_sex_frontier",
    """
    SELECT c_custkey, category, sex FROM customer,
      (VALUES ('worker-safety-health-documents'), ('nuclear-safety-enforcement-documents'),
              ('security-enforcement-documents')) AS c(category),
      (VALUES ('F'), ('M')) AS s(sex)""",
)
def category_sex_frontier(spark, sf):
    return O.cross_frontier(
        table(spark, sf, "customer").select("c_custkey"), category=rules.ENERGY_CATEGORIES, sex=rules.SEXES
    )


def user_captions(spark, sf):
    counts = count_by(table(spark, sf, "events"), ["user_id"])
    return counts.withColumn("caption", F.concat(F.lit("Showing 1 to 10 of "), F.format_number("n", 0), F.lit(" entries")))


@query(
    "caption_pages",
    """
    SELECT user_id, count(*) AS total, CAST(ceil(count(*) / 96.0) AS BIGINT) AS n_pages FROM events GROUP BY user_id""",
)
def caption_pages(spark, sf):
    return O.page_count(user_captions(spark, sf), "caption", rules.PAGE_SIZES["pcaob"]).select("user_id", "total", "n_pages")


@query(
    "last_page_links",
    """
    SELECT page_id,
           TRY_CAST(CASE WHEN strpos(url, '=') > 0 THEN string_split(url, '=')[2] END AS BIGINT) + 1 AS from_first,
           TRY_CAST(string_split(url, '=')[-1] AS BIGINT) + 1 AS from_last,
           TRY_CAST(regexp_extract(url, '([0-9]+)', 1) AS BIGINT) AS as_shown
    FROM (SELECT page_id, replace(url, '&ref=x', '') AS url FROM pages)""",
)
def last_page_links(spark, sf):
    """Zero-based number behind '=' in the address, or a number as printed."""
    pages = table(spark, sf, "pages").select("page_id", F.replace("url", F.lit("&ref=x"), F.lit("")).alias("url"))
    first = O.last_page(pages, "url", "first_value").withColumnRenamed("n_pages", "from_first")
    both = O.last_page(first, "url", "last_value").withColumnRenamed("n_pages", "from_last")
    shown = both.withColumn("text", F.regexp_extract("url", "([0-9]+)", 1))
    return O.last_page(shown, "text", "shown").select("page_id", "from_first", "from_last", F.col("n_pages").alias("as_shown"))


def user_pagers(spark, sf):
    """A pager per user: pages 1 to n as shown, the last one linked by its zero-based number."""
    n = F.col("n").cast("string")
    html = F.concat(
        F.lit('<span>Results: '), F.format_number("n", 0),
        F.lit('</span><ul><li class="page-item"><a href="?page=0">1</a></li><li class="page-item"> '), n,
        F.lit('</li> <li class="usa next-page"><a href="?page=1">next</a></li><li class="page-item">'
              '<a href="?size=50&amp;page='), (F.col("n") - 1).cast("string"), F.lit('" title="Go to last page">last</a></li></ul>'),
    )
    return count_by(table(spark, sf, "events"), ["user_id"]).select("user_id", html.alias("html"))


@query(
    "pager_pages",
    "SELECT user_id, count(*) AS titled, count(*) AS shown, CAST(ceil(count(*) / 96.0) AS BIGINT) AS counted "
    "FROM events GROUP BY user_id",
)
def pager_pages(spark, sf):
    """Page counts from the last-page link, the item in front of 'next' and a caption."""
    pagers = user_pagers(spark, sf)
    caption = F.regexp_extract("html", "<span>([^<]*)</span>", 1)
    captions = O.page_count(pagers.withColumn("caption", caption), "caption", rules.PAGE_SIZES["pcaob"], ": ")
    both = O.pager(captions.withColumnRenamed("n_pages", "counted").withColumn("copy", F.col("html")), "titled", "a")
    both = O.last_page(both, "a", "last_value").withColumnRenamed("n_pages", "titled")
    both = O.pager(both.withColumnRenamed("copy", "html"), "shown", "b")
    return O.last_page(both, "b", "shown").select("user_id", "titled", F.col("n_pages").alias("shown"), "counted")


@query(
    "page_frontier",
    """
    SELECT user_id, CAST(unnest(range(0, CAST(ceil(n / 96.0) AS BIGINT))) AS BIGINT) AS page
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""",
)
def page_frontier(spark, sf):
    counted = O.page_count(user_captions(spark, sf), "caption", rules.PAGE_SIZES["pcaob"])
    return O.expand_pages(counted, "n_pages", 0).select("user_id", "page")


@query(
    "further_page_frontier",
    """
    SELECT user_id, CAST(unnest(range(2, CAST(ceil(n / 50.0) AS BIGINT) + 1)) AS BIGINT) AS page
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)""",
)
def further_page_frontier(spark, sf):
    """Pages after the first; users with a single page give none."""
    counted = O.page_count(user_captions(spark, sf), "caption", rules.PAGE_SIZES["railroads"])
    return O.expand_pages(counted, "n_pages", 2).select("user_id", "page")


@query(
    "listing_progress",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS reached, CAST(50 AS BIGINT) AS total,
           CAST(l_quantity AS BIGINT) = 50 AS done
    FROM lineitem""",
)
def listing_progress(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.concat(F.lit("1 - "), F.col("l_quantity").cast("bigint").cast("string"), F.lit(" of 50")).alias("caption"),
    )
    return O.progress(rows, "caption").drop("caption")


@query(
    "age_bands",
    """
    WITH bands(lo, hi) AS (
      SELECT 0, 20 UNION ALL SELECT i, i FROM range(21, 50) AS t(i) UNION ALL SELECT 51, 60 UNION ALL SELECT 60, 100)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(lo AS INTEGER) AS age_lo, CAST(hi AS INTEGER) AS age_hi
    FROM lineitem JOIN bands ON CAST(l_quantity AS INTEGER) + 12 BETWEEN lo AND hi""",
)
def age_bands(spark, sf):
    """Ranges as the service was asked: 50 falls through, 60 counts twice."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity").cast("int") + 12).alias("age")
    )
    out = O.band(rows, "age", rules.age_bands(spark, rules.AGE_BANDS_AS_QUERIED))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "age_lo", "age_hi")


PEOPLE_SQL = """
    SELECT c_nationkey AS country, CASE WHEN c_acctbal < 0 THEN 'U' WHEN c_mktsegment < 'G' THEN 'F' ELSE 'M' END AS sex,
           CAST(c_custkey % 81 AS INTEGER) AS age, c_mktsegment AS warrant
    FROM customer"""
QUOTA = 12


@query(
    "quota_leaves",
    f"""
    WITH people AS ({PEOPLE_SQL}),
    bands(lo, hi, splits) AS (
      SELECT 0, 20, false UNION ALL SELECT i, i, true FROM range(21, 51) AS t(i)
      UNION ALL SELECT 51, 60, false UNION ALL SELECT 61, 100, false),
    n1 AS (SELECT *, count(*) OVER (PARTITION BY country) AS c1, count(*) OVER (PARTITION BY country, sex) AS c2 FROM people),
    leaves AS (
      SELECT country, NULL AS sex, NULL AS age_lo, NULL AS age_hi, NULL AS warrant FROM n1 WHERE c1 <= {QUOTA}
      UNION ALL SELECT country, sex, NULL, NULL, NULL FROM n1 WHERE c1 > {QUOTA} AND sex IN ('F', 'M') AND c2 <= {QUOTA}
      UNION ALL SELECT country, sex, lo, hi, CASE WHEN splits AND c3 > {QUOTA} THEN warrant END FROM (
        SELECT n1.*, lo, hi, splits, count(*) OVER (PARTITION BY country, sex, lo) AS c3
        FROM n1 JOIN bands ON age BETWEEN lo AND hi WHERE c1 > {QUOTA} AND sex IN ('F', 'M') AND c2 > {QUOTA}))
    SELECT CAST(country AS INTEGER) AS country, CAST(sex AS VARCHAR) AS sex, CAST(age_lo AS INTEGER) AS age_lo,
           CAST(age_hi AS INTEGER) AS age_hi, CAST(warrant AS VARCHAR) AS warrant,
           count(*) AS n, count(*) > {QUOTA} AS overflow
    FROM leaves GROUP BY 1, 2, 3, 4, 5""",
)
def quota_leaves(spark, sf):
    people = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS country",
        "CASE WHEN c_acctbal < 0 THEN 'U' WHEN c_mktsegment < 'G' THEN 'F' ELSE 'M' END AS sex",
        "CAST(c_custkey % 81 AS INT) AS age",
        "c_mktsegment AS warrant",
    )
    return quota_split(people, rules.age_bands(spark), QUOTA, rules.SEXES)


@query(
    "unknown_sex_leaf",
    f"SELECT 'U' AS sex, count(*) AS n, count(*) >= {rules.NOTICE_QUOTA} AS overflow FROM customer WHERE c_acctbal < 0",
)
def unknown_sex(spark, sf):
    people = table(spark, sf, "customer").select(F.when(F.col("c_acctbal") < 0, "U").otherwise("M").alias("sex"))
    return unknown_sex_leaf(people, rules.NOTICE_QUOTA)


@query(
    "quota_accounts",
    "SELECT c_nationkey AS country, count(*) AS people, count(*) AS placed FROM customer GROUP BY 1",
)
def quota_accounts(spark, sf):
    """Leaves and remainder of each country add up, with unknown sexes, ages beyond the bands and no warrant countries."""
    people = table(spark, sf, "customer").selectExpr(
        "c_nationkey AS country",
        "CASE WHEN c_acctbal < 0 THEN NULL WHEN c_mktsegment < 'C' THEN 'U' WHEN c_mktsegment < 'G' THEN 'F' ELSE 'M' END AS sex",
        "CAST(nullif(c_custkey % 131, 7) AS INT) AS age",
        "nullif(c_mktsegment, 'MACHINERY') AS warrant",
    )
    parts = [people, rules.age_bands(spark), QUOTA, rules.SEXES]
    placed = quota_split(*parts).select("country", "n").unionByName(quota_remainder(*parts).select("country", "n"))
    counted = people.groupBy("country").agg(F.count("*").alias("people"))
    return counted.join(placed.groupBy("country").agg(F.sum("n").alias("placed")), "country")


@query(
    "late_year_rules",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) + 300 AS INTEGER) AS year FROM orders WHERE o_orderstatus = 'F'""",
)
def late_year_rules(spark, sf):
    """Rules without a last year hold for any year."""
    later = (F.year("o_orderdate") + 300).cast("int").alias("year")
    dated = table(spark, sf, "orders").select("o_orderkey", later, F.lit("admin").alias("site"), "o_orderstatus")
    held = O.apply_year_rules(dated.where("o_orderstatus = 'F'"), rules.year_rules(spark))
    return held.select("o_orderkey", "year")


@query(
    "years_without_rule",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderstatus = 'P' OR year(o_orderdate) < 1994",
)
def years_without_rule(spark, sf):
    """Orders of a site without rules, and years before its rules, come back as rejects."""
    year = F.year("o_orderdate")
    site = F.when(F.col("o_orderstatus") == "P", "no such site").otherwise("litigation")
    moved = F.when(year < 1994, year - 100).otherwise(F.greatest(year, F.lit(2000)))
    dated = table(spark, sf, "orders").select("o_orderkey", year.alias("shown"), moved.alias("year"), site.alias("site"))
    return O.without_rule(dated, rules.year_rules(spark)).select("o_orderkey", F.col("shown").alias("year"))
