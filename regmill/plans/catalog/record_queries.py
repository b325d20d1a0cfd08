"""Queries that build documents, penalty and notice records."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmill import rules, schemas
from regmill.functions.text import capitalize, strip
from regmill.operators import outcomes as O
from regmill.operators import records as R
from regmill.operators.links import filings_between
from regmill.operators.ordered import count_by
from regmill.plans import notices as N
from regmill.plans.catalog import derived
from regmill.plans.catalog.registry import DEMO_KEY, query, sql_keyed_id, sql_strip, table
from regmill.rules import local_frame
from regmill.session import fresh_dir
from regmill.sources.readers import decode_json

# --- responses and notices ----------------------------------------------------


@query(
    "decoded_responses",
    """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS k FROM events""",
)
def decoded_responses(spark, sf):
    decoded = decode_json(table(spark, sf, "events"), "props", "k bigint")
    return decoded.select("event_id", F.col("body.k").alias("k"))


def responses(spark, sf):
    return decode_json(derived.notice_responses(spark, sf), "response", schemas.NOTICE_RESPONSE)


def details(spark, sf):
    decoded = decode_json(derived.notice_details(spark, sf), "response", schemas.NOTICE_DETAIL)
    return decoded.select("detail_url", "body.*")


@query(
    "response_totals",
    "SELECT CAST(1 AS BIGINT) AS total, CAST(160 AS BIGINT) AS page_size, count(*) AS n FROM customer",
)
def response_totals(spark, sf):
    held = responses(spark, sf).select(
        F.col("body.total").alias("total"), F.col("body.query.resultPerPage").alias("page_size")
    )
    return count_by(held, ["total", "page_size"])


@query(
    "notices",
    """
    SELECT 'N/' || c_custkey AS entity_id, c_name AS name, '/notice/' || c_custkey AS detail_url,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN '/image/' || c_custkey END AS picture
    FROM customer""",
)
def notices(spark, sf):
    rows = R.explode_notices(responses(spark, sf))
    return rows.select("entity_id", "name", "detail_url", F.col("entity_profile_image_url").alias("picture"))


# The detail side of a notice as the reference data would merge it, from customers.
MERGED_SQL = """
    SELECT c_custkey, 'N/' || c_custkey AS entity_id, CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'D' || c_name END AS name,
           'F' || c_custkey AS forename, c_mktsegment AS segment, c_nationkey, c_acctbal,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN '/image/' || c_custkey END AS picture
    FROM customer"""


@query("merged_notices", f"SELECT entity_id, name, forename, picture FROM ({MERGED_SQL})")
def merged_notices(spark, sf):
    """The detail wins on every shared key, also where its value is null."""
    merged = R.merge_right(R.explode_notices(responses(spark, sf)), details(spark, sf), "detail_url")
    return merged.select("entity_id", "name", "forename", F.col("entity_profile_image_url").alias("picture"))


@query(
    "first_warrants",
    """
    SELECT '/notice/' || c_custkey AS detail_url, 'charge ' || c_custkey AS charge, 'US' AS issuing_country_id
    FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'""",
)
def first_warrants(spark, sf):
    """Fields of the first warrant; notices with an empty list drop out."""
    return R.promote_first(details(spark, sf), "arrest_warrants").select("detail_url", "charge", "issuing_country_id")


@query(
    "birth_dates",
    """
    SELECT '/notice/' || c_custkey AS detail_url,
           CASE c_mktsegment WHEN 'MACHINERY' THEN (1940 + c_nationkey) || '-01-01T00:00:00.000Z'
                             WHEN 'HOUSEHOLD' THEN NULL
                             ELSE (1940 + c_nationkey) || '-05-03T00:00:00.000Z' END AS entity_dob
    FROM customer""",
)
def birth_dates(spark, sf):
    return R.normalize_dob(details(spark, sf)).select("detail_url", "entity_dob")


NOTE_SQL = """
    'Physical description: ' || CASE WHEN c_acctbal > 8000 THEN 'weight: ' || c_nationkey || '; ' ELSE '' END
      || CASE WHEN c_acctbal > 2000 THEN 'hair_colour: BRO; ' ELSE '' END
      || CASE WHEN c_acctbal > 9000 THEN 'eyes_colour: BLU; ' ELSE '' END ||
      'languages_spoken: L' || c_nationkey || ';' || CASE WHEN c_acctbal > 5000 THEN ' distinguishing_marks: tall;' ELSE '' END"""


@query("physical_notes", f"SELECT '/notice/' || c_custkey AS detail_url, {NOTE_SQL} AS entity_notes FROM customer")
def physical_notes(spark, sf):
    renamed = details(spark, sf).withColumnsRenamed(rules.NOTICE_RENAMES)
    return R.fold_attributes(renamed).select("detail_url", "entity_notes")


RED_SQL = f"""
    SELECT m.*, {NOTE_SQL} AS entity_notes, 'charge ' || c_custkey AS charge,
           CASE WHEN segment = 'MACHINERY' THEN (1940 + c_nationkey) || '-01-01T00:00:00.000Z'
                ELSE (1940 + c_nationkey) || '-05-03T00:00:00.000Z' END AS entity_dob
    FROM ({MERGED_SQL}) AS m WHERE segment NOT IN ('AUTOMOBILE', 'HOUSEHOLD')"""


@query(
    "red_notice_documents",
    f"""
    SELECT entity_id, name AS entity_last_name, forename AS entity_first_name, segment AS entity_place_of_birth,
           CAST(c_nationkey AS VARCHAR) AS entity_place_of_birth_country, charge AS relationship_details, entity_dob,
           picture AS entity_profile_image_url, 'Red Notice' AS doc_source_type, 'INTERPOL' AS doc_source,
           'individual' AS entity_type, 'enforcement' AS relationship_type, entity_notes,
           {sql_keyed_id('entity_id')} AS document_id
    FROM ({RED_SQL})""",
)
def red_notice_documents(spark, sf):
    """The whole notice flow."""
    documents, _ = N.notice_documents(responses(spark, sf), details(spark, sf), "red", DEMO_KEY)
    return documents.select(
        "entity_id", "entity_last_name", "entity_first_name", "entity_place_of_birth", "entity_place_of_birth_country",
        "relationship_details", "entity_dob", "entity_profile_image_url", "doc_source_type", "doc_source",
        "entity_type", "relationship_type", "entity_notes", "document_id",
    )


@query(
    "yellow_notice_rejects",
    "SELECT 'N/' || c_custkey AS entity_id, 'birth date' AS reason FROM customer WHERE c_mktsegment = 'HOUSEHOLD'",
)
def yellow_notice_rejects(spark, sf):
    _, rejects = N.notice_documents(responses(spark, sf), details(spark, sf), "yellow", DEMO_KEY)
    return rejects.select("entity_id", "reason")


@query(
    "red_notice_rejects",
    """
    SELECT entity_id, reason FROM (
      SELECT 'N/' || c_custkey AS entity_id,
             CASE WHEN c_acctbal <= 5000 THEN 'no detail' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'no warrant'
                  WHEN c_mktsegment = 'HOUSEHOLD' THEN 'birth date' END AS reason FROM customer)
    WHERE reason IS NOT NULL""",
)
def red_notice_rejects(spark, sf):
    """Every notice that does not become a document, with the first reason."""
    known = details(spark, sf).where("distinguishing_marks IS NOT NULL")
    _, rejects = N.notice_documents(responses(spark, sf), known, "red", DEMO_KEY)
    return rejects.select("entity_id", "reason")


@query(
    "renamed_notices",
    f"""
    SELECT entity_id, name AS entity_last_name, forename AS entity_first_name, charge AS relationship_details,
           CAST(13 AS BIGINT) AS n_columns FROM (
      SELECT m.*, 'charge ' || c_custkey AS charge FROM ({MERGED_SQL}) AS m WHERE segment <> 'AUTOMOBILE')""",
)
def renamed_notices(spark, sf):
    promoted = R.promote_first(details(spark, sf), "arrest_warrants").drop("height", "weight")
    renamed = R.rename_notice(promoted, "red")
    return renamed.select(
        "entity_id", "entity_last_name", "entity_first_name", "relationship_details",
        F.lit(len(renamed.columns)).cast("bigint").alias("n_columns"),
    )


@query(
    "sparse_documents",
    """
    SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
      || CASE WHEN c_acctbal > 0 THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END || '}' AS document
    FROM customer""",
)
def sparse_documents(spark, sf):
    """Keys without a value are left out row by row."""
    c = table(spark, sf, "customer")
    some = c.select("c_custkey", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment"))
    return R.to_sparse(some, "c_custkey")


# --- dates and amounts --------------------------------------------------------


@query(
    "normalized_dates",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS long_form,
           strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS slash_form, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS plain_form,
           NULL::VARCHAR AS unparsable
    FROM orders""",
)
def normalized_dates(spark, sf):
    day = F.col("o_orderdate")
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(day, "MMMM d, yyyy").alias("a"),
        F.date_format(day, "MM/dd/yyyy").alias("b"),
        F.upper(F.date_format(day, "MMMM dd yyyy")).alias("c"),
        F.date_format(day, "d.M.yyyy").alias("d"),
    )
    for column, fmt, into in (
        ("a", "month_day_comma_year", "long_form"),
        ("b", "month_day_slash_year", "slash_form"),
        ("c", "month_day_year", "plain_form"),
        ("d", "month_day_year", "unparsable"),
    ):
        texts = R.normalize_dates(texts, column, fmt, into)
    return texts.select("o_orderkey", "long_form", "slash_form", "plain_form", "unparsable")


@query(
    "repaired_dates",
    """
    SELECT o_orderkey, CASE
        WHEN strftime(o_orderdate, '%B %Y') = 'March 1998' THEN '2010-03-25T00:00:00'
        WHEN strftime(o_orderdate, '%B %Y') = 'April 1998' THEN '2010-04-29T00:00:00'
        WHEN strftime(o_orderdate, '%B %Y') = 'December 1998' THEN '2010-12-01T00:00:00'
        WHEN strftime(o_orderdate, '%B %d %Y') = 'February 10 1999' THEN '2011-02-10T00:00:00'
        ELSE strftime(o_orderdate, '%Y-%m-%dT00:00:00') END AS day
    FROM orders""",
)
def repaired_dates(spark, sf):
    """Orders of a few months carry the known incomplete dates."""
    month = F.date_format("o_orderdate", "MMMM yyyy")
    full = F.date_format("o_orderdate", "MMMM d yyyy")
    raw = (
        F.when(month.isin("March 1998", "April 1998", "December 1998"), F.replace(month, F.lit("1998"), F.lit("2010")))
        .when(full == "February 10 1999", F.lit("(February 10 2011"))
        .otherwise(full)
    )
    texts = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    fixed = R.repair_dates(texts, "raw", rules.date_fixes(spark))
    return R.normalize_dates(fixed, "raw", "month_day_year", "day").select("o_orderkey", "day")


@query(
    "fiscal_stamps",
    """
    SELECT o_orderkey, 'PENALTY COLLECTIONS FY ' || year(o_orderdate) AS message_title,
           year(o_orderdate) || '-12-31T00:00:00.000Z' AS time_master, year(o_orderdate) || '-12-31T00:00:00.000Z' AS time_document
    FROM orders""",
)
def fiscal_stamps(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return R.fiscal_stamp(dated, "year").drop("year")


@query(
    "load_stamps",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS collected, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS uploaded FROM orders",
)
def load_stamps(spark, sf):
    """The clock as a parameter."""
    stamped = R.stamp(table(spark, sf, "orders"), F.col("o_orderdate"))
    return stamped.select(
        "o_orderkey",
        F.date_format("time_collected", "yyyy-MM-dd HH:mm:ss").alias("collected"),
        F.date_format("time_uploaded", "yyyy-MM-dd HH:mm:ss").alias("uploaded"),
    )


@query(
    "parsed_amounts",
    """
    SELECT c_custkey, TRY_CAST(nullif(regexp_replace(
             CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE '$ ' || CAST(CAST(c_acctbal * 100 AS BIGINT) AS VARCHAR) || ',00' END,
             '[^0-9]', '', 'g'), '') AS BIGINT) AS amount
    FROM customer""",
)
def parsed_amounts(spark, sf):
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    texts = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "n/a").otherwise(F.concat(F.lit("$ "), cents, F.lit(",00"))).alias("text"),
    )
    return R.parse_amount(texts, "text", "amount").select("c_custkey", "amount")


@query(
    "split_regulations",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE l_returnflag WHEN 'A' THEN 'Late report ' WHEN 'R' THEN 'Part ' || l_partkey || ' missing; ' END AS violation,
           CASE l_returnflag WHEN 'A' THEN '30 CFR ' || l_suppkey || ' ' WHEN 'R' THEN '30 CFR 1241 ' END AS regulation
    FROM lineitem""",
)
def split_regulations(spark, sf):
    """List order beats position: 'Part' comes first in the text, '30 CFR' first in the list."""
    texts = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f"{derived.PENALTY_CITE} AS cite"
    )
    return R.split_regulation(texts, "cite").drop("cite")


# --- documents ----------------------------------------------------------------


def document_records(spark, sf):
    """Documents as records; the body is missing where the language is Spanish."""
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id",
        F.concat(F.lit("Title "), F.col("doc_id").cast("string")).alias("message_title"),
        F.when(F.col("lang") != "es", F.col("text")).alias("message_body"),
        F.lit("Press Release").alias("doc_source_type"),
        F.col("source").alias("doc_source"),
        F.col("lang").alias("doc_source_url"),
        F.col("n_chars").cast("string").alias("doc_source_pdf_url"),
        F.lit("2020-01-01T00:00:00").alias("time_master"),
        F.lit("2020-01-01T00:00:00").alias("time_document"),
    )


MESSAGE_SQL = """
    SELECT doc_id, 'Title ' || doc_id || CASE WHEN lang <> 'es' THEN text END || 'Press Release' || source || lang
      || n_chars || '2020-01-01T00:00:002020-01-01T00:00:00' AS message
    FROM documents"""


@query("canonical_messages", MESSAGE_SQL)
def canonical_messages(spark, sf):
    return R.canonical_message(document_records(spark, sf)).select("doc_id", "message")


@query("document_ids", f"SELECT doc_id, {sql_keyed_id('message')} AS document_id FROM ({MESSAGE_SQL})")
def document_ids(spark, sf):
    keyed = R.document_id(R.canonical_message(document_records(spark, sf)), "message", DEMO_KEY)
    return keyed.select("doc_id", "document_id")


@query(
    "rejected_documents",
    "SELECT doc_id, 'no body' AS reason FROM documents WHERE lang = 'es' UNION ALL "
    "SELECT doc_id, 'too short' FROM documents WHERE lang <> 'es' AND length(text) < 200",
)
def rejected_documents(spark, sf):
    _, bad = R.split_rejects(
        document_records(spark, sf),
        {"no body": F.col("message_body").isNotNull(), "too short": F.length("message_body") >= 200},
    )
    return bad.select("doc_id", "reason")


@query(
    "counted_outcomes",
    """
    SELECT CASE WHEN lang = 'es' THEN 'no body' WHEN length(text) < 200 THEN 'too short' WHEN doc_id % 5 = 0 THEN 'already held'
                ELSE 'good' END AS outcome, count(*) AS n, count(*) AS n_written FROM documents GROUP BY 1""",
)
def counted_outcomes(spark, sf):
    """Outcomes as counted by the job that wrote the documents, next to what it wrote."""
    checks = {"no body": F.col("message_body").isNotNull(), "too short": F.length("message_body") >= 200}
    done = O.write_outcomes(document_records(spark, sf), fresh_dir(spark, "outcomes"), checks, F.col("doc_id") % 5 == 0)
    counted = local_frame(spark, [kv for kv in done.counts.items() if kv[1]], "outcome string, n bigint")
    stored = done.bad.select("reason").unionAll(done.good.select(F.lit(O.GOOD))).toDF("outcome")
    return counted.join(stored.groupBy("outcome").agg(F.count("*").alias("n_written")), "outcome", "full")


@query(
    "enriched_documents",
    """
    SELECT c_custkey, 'Red Notice' AS doc_source_type, 'INTERPOL' AS doc_source, 'individual' AS entity_type,
           'enforcement' AS relationship_type FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT c_custkey, 'Press Release', 'US Food & Drug Administration Criminal Division', NULL, NULL
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def enriched_documents(spark, sf):
    source = F.when(F.col("c_mktsegment") == "BUILDING", "red").otherwise("fda")
    rows = table(spark, sf, "customer").select("c_custkey", source.alias("source"))
    return R.enrich(rows, rules.sources(spark)).drop("source")


@query(
    "capitalized_labels",
    "SELECT doc_id, upper(substr(text, 1, 1)) || lower(substr(text, 2)) AS label FROM documents",
)
def capitalized_labels(spark, sf):
    return table(spark, sf, "documents").select("doc_id", capitalize(F.col("text")).alias("label"))


@query(
    "stripped_texts",
    f"SELECT doc_id, {sql_strip('chr(160) || text || chr(8195) || chr(10)')} AS text FROM documents",
)
def stripped_texts(spark, sf):
    padded = F.concat(F.lit(" "), "text", F.lit(" \n"))
    return table(spark, sf, "documents").select("doc_id", strip(padded).alias("text"))


@query(
    "filings_in_window_by_customer",
    """
    SELECT o_custkey, count(*) AS n FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-12-31' AND o_orderdate < TIMESTAMP '1999-01-01' GROUP BY o_custkey""",
)
def filings_in_window_by_customer(spark, sf):
    return count_by(filings_between(table(spark, sf, "orders"), "1997-12-31", "1999-01-01", "o_orderdate"), ["o_custkey"])
