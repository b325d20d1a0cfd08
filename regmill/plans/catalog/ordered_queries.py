"""Queries whose result depends on order: first, carried, versioned and cut rows; and plain counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from regmill.operators import ordered as O
from regmill.plans.catalog.derived import LINKS_SQL, order_links
from regmill.plans.catalog.registry import query, table
from regmill.sources.readers import scan_table_rows


@query("document_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def document_counts(spark, sf):
    return O.count_by(table(spark, sf, "documents"), ["lang", "source"])


@query("index_count", "SELECT count(*) AS n FROM documents")
def index_count(spark, sf):
    return O.count_by(table(spark, sf, "documents"), [])


@query("first_seen_documents", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def first_seen_documents(spark, sf):
    """First of each equal text; texts are compared by digest, so only digests are shuffled."""
    digests = table(spark, sf, "documents").select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"))
    return O.first_seen(digests, ["digest"], [], ["doc_id"]).select("doc_id")


@query("first_seen_links_by_year", f"SELECT year, href, min(seq) AS seq FROM ({LINKS_SQL}) GROUP BY year, href")
def first_seen_links_by_year(spark, sf):
    """The list of seen links starts anew each year."""
    return O.first_seen(order_links(spark, sf), ["href"], ["year"], ["seq"]).select("year", "href", "seq")


@query(
    "table_row_places",
    """
    SELECT l_suppkey AS doc, l_linenumber AS table_no, l_orderkey AS row_no, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def table_row_places(spark, sf):
    rows = scan_table_rows(spark, f"{sf}/lineitem.parquet", doc="l_suppkey", table_no="l_linenumber", row_no="l_orderkey")
    return O.count_by(rows, ["doc", "table_no", "row_no"])


@query(
    "assembled_conversations",
    """
    SELECT conv_id, record_no, string_agg(text, '' ORDER BY turn) AS text, max(CASE WHEN closes THEN turn END) AS closed_at
    FROM (SELECT conv_id, turn, text, closes, coalesce(sum(CASE WHEN closes THEN 1 ELSE 0 END)
                   OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS record_no
          FROM (SELECT conv_id, turn, text, role = 'assistant' AS closes FROM conversations))
    GROUP BY conv_id, record_no HAVING max(CASE WHEN closes THEN turn END) IS NOT NULL""",
)
def assembled_conversations(spark, sf):
    """Turns gathered until an assistant turn closes the record; an open tail is no record."""
    return O.assemble_records(
        table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"),
        by=["conv_id"],
        order=["turn"],
        pieces={"text": F.col("text")},
        closes=F.col("role") == "assistant",
        closing={"closed_at": F.col("turn")},
    )


@query(
    "carried_parents",
    """
    SELECT event_id, event_type, user_id,
           last_value(CASE WHEN value > 30 THEN props END IGNORE NULLS)
             OVER (PARTITION BY event_type ORDER BY event_id) AS parent
    FROM events""",
)
def carried_parents(spark, sf):
    """Most recent large event's properties per event type, a handful of very large groups."""
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "user_id", F.when(F.col("value") > 30, F.col("props")).alias("own")
    )
    return O.forward_fill(events, "own", ["event_type"], ["event_id"], "parent").drop("own")


@query(
    "since_marks",
    """
    WITH marks AS (SELECT event_type, arg_min(props, event_id) AS mark FROM events WHERE value > 30 GROUP BY event_type),
    cut AS (SELECT e.event_type, max(event_id) AS reached FROM events e JOIN marks m
            ON e.event_type = m.event_type AND e.props = m.mark GROUP BY 1)
    SELECT event_id, e.event_type FROM events e LEFT JOIN cut USING (event_type) WHERE reached IS NULL OR event_id > reached""",
)
def since_marks(spark, sf):
    """Newest-first events in front of the title held first in the index of their type."""
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "value", F.col("props").alias("title"), (-F.col("event_id")).alias("pos")
    )
    marks = O.high_water(events.where("value > 30"), ["event_type"], "title", ["event_id"])
    return O.since_mark(events, marks, ["event_type"], "title", "pos").select("event_id", "event_type")


@query(
    "high_water_marks",
    "SELECT lang, arg_min(text, doc_id) AS mark FROM documents GROUP BY lang",
)
def high_water_marks(spark, sf):
    return O.high_water(table(spark, sf, "documents"), ["lang"], "text", ["doc_id"])


@query(
    "running_signups",
    """
    SELECT event_id, count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id ORDER BY event_id) AS signups
    FROM events""",
)
def running_signups(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    flag = F.col("event_type") == "signup"
    return O.running_count(events, flag, ["user_id"], ["event_id"], "signups", inclusive=True).select("event_id", "signups")


HOT_EVENTS_SQL = """
    SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS who, event_type, event_id,
           epoch_us(ts) // 1000000 * 1000003 AS place FROM events"""


@query(
    "sparse_hot_counts",
    f"""
    SELECT who, event_id, count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY who ORDER BY place, event_id) AS n,
           last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
             OVER (PARTITION BY who ORDER BY place, event_id) AS latest
    FROM ({HOT_EVENTS_SQL})""",
)
def sparse_hot_counts(spark, sf):
    """Running count and last value where order values lie far apart and one user has a third of all events."""
    events = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("who"),
        "event_type",
        "event_id",
        (F.unix_timestamp("ts") * 1000003).alias("place"),
    )
    bought = F.col("event_type") == "purchase"
    order = ["place", "event_id"]
    counted = O.running_count(events, bought, ["who"], order, "n", inclusive=True)
    marked = counted.withColumn("own", F.when(bought, F.col("event_id")))
    return O.forward_fill(marked, "own", ["who"], order, "latest").select("who", "event_id", "n", "latest")
