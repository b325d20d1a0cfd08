"""Queries that write and read back: keyed tables, layouts, files, incremental loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from regmill.operators import layout
from regmill.operators import store as S
from regmill.operators import versions as V
from regmill.operators.ordered import count_by
from regmill.plans.catalog.derived import LINKS_SQL, order_links
from regmill.plans.catalog.registry import query, table
from regmill.session import fresh_dir
from regmill.sources.readers import scan_csv, scan_held
from regmill.streaming.incremental import run_incremental
from regmill.streaming.live import run_live

LAST_ORDER_SQL = "SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey"


def order_writes(spark, sf):
    """Orders as writes under their customer's id."""
    return table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")


@query(
    "upserted_index",
    f"""
    SELECT c_custkey AS o_custkey, coalesce(o_orderkey, -1) AS o_orderkey, coalesce(o_orderstatus, 'new') AS o_orderstatus
    FROM customer LEFT JOIN ({LAST_ORDER_SQL}) ON c_custkey = o_custkey""",
)
def upserted_index(spark, sf):
    target = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.lit(-1).cast("bigint").alias("o_orderkey"),
        F.lit("new").alias("o_orderstatus"),
    )
    return S.upsert(target, order_writes(spark, sf), ["o_custkey"], ["o_orderkey"])


@query(
    "write_versions",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS version FROM orders",
)
def write_versions(spark, sf):
    versions = S.write_versions(order_writes(spark, sf), ["o_custkey"], ["o_orderkey"])
    return versions.select("o_custkey", "o_orderkey", "version")


@query(
    "duplicate_audit",
    """
    SELECT o_custkey, count(*) AS repeats FROM (
      SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS version FROM orders)
    WHERE version > 1 GROUP BY o_custkey""",
)
def duplicate_audit(spark, sf):
    versions = S.write_versions(order_writes(spark, sf), ["o_custkey"], ["o_orderkey"])
    return count_by(versions.where("version > 1"), ["o_custkey"]).withColumnRenamed("n", "repeats")


@query(
    "index_after_batches",
    """
    SELECT o_custkey, arg_max(o_orderkey, (o_orderstatus, o_orderkey)) AS o_orderkey, max(o_orderstatus) AS o_orderstatus
    FROM orders GROUP BY o_custkey""",
)
def index_after_batches(spark, sf):
    """Three batches, one written twice as after a lost job, read back as one index."""
    root = fresh_dir(spark, "index")
    writes = order_writes(spark, sf)
    for batch_id, status in enumerate(["F", "O", "P", "P"]):
        S.append_batch(writes.where(F.col("o_orderstatus") == status), root, min(batch_id, 2))
    return S.read_index(spark, root, ["o_custkey"], ["o_orderkey"]).drop(*S.PLACE)


@query("incremental_index", LAST_ORDER_SQL)
def incremental_index(spark, sf):
    """Orders taken as a file stream into a new index until nothing is left."""
    root = fresh_dir(spark, "stream-index")
    schema = table(spark, sf, "orders").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
    run_incremental(
        stream, root, fresh_dir(spark, "stream-state"), lambda b: b.select("o_custkey", "o_orderkey", "o_orderstatus")
    ).awaitTermination()
    return S.read_index(spark, root, ["o_custkey"], ["o_orderkey"]).drop(*S.PLACE)


@query(
    "history_then_live",
    """
    SELECT o_custkey, arg_max(o_orderkey, (o_orderstatus <> 'F', o_orderkey)) AS o_orderkey,
           arg_max(o_orderstatus, (o_orderstatus <> 'F', o_orderkey)) AS o_orderstatus
    FROM orders GROUP BY o_custkey""",
)
def history_then_live(spark, sf):
    """A full load of the closed orders, then a stream of the others into the same index: both are kept."""
    root = fresh_dir(spark, "two-loads")
    S.append_batch(order_writes(spark, sf).where("o_orderstatus = 'F'"), root, 0, S.next_load(spark, root), "history")
    stream = spark.readStream.schema(table(spark, sf, "orders").schema)
    stream = stream.option("pathGlobFilter", "orders.parquet").parquet(sf)
    live = lambda b: b.where("o_orderstatus <> 'F'").select("o_custkey", "o_orderkey", "o_orderstatus")
    run_incremental(stream, root, fresh_dir(spark, "live-state"), live, "live").awaitTermination()
    return S.read_index(spark, root, ["o_custkey"], ["o_orderkey"]).drop(*S.PLACE)


@query(
    "two_sources_one_index",
    "SELECT o_custkey, count(*) AS writes, count(DISTINCT o_orderstatus) AS sources FROM orders GROUP BY o_custkey",
)
def two_sources_one_index(spark, sf):
    """Batches of equal numbers from several sources do not replace each other."""
    root = fresh_dir(spark, "sources")
    writes = order_writes(spark, sf)
    for status in ("F", "O", "P"):
        S.append_batch(writes.where(F.col("o_orderstatus") == status), root, 0, 0, status)
    held = S.read_writes(spark, root).groupBy("o_custkey")
    return held.agg(F.count("*").alias("writes"), F.count_distinct("source").alias("sources"))


@query("layout_site_after_site", "SELECT c_mktsegment AS site, count(*) AS n FROM customer GROUP BY 1")
def layout_site_after_site(spark, sf):
    """Each site is written by a job of its own; earlier sites stay."""
    root = fresh_dir(spark, "sites")
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("site"))
    for low, high in (("A", "C"), ("C", "I"), ("I", "Z")):
        S.write_layout(rows.where((F.col("site") >= low) & (F.col("site") < high)), root, ["site"], ["c_custkey"])
    return spark.read.parquet(root).groupBy("site").agg(F.count("*").alias("n"))


@query("random_ids", "SELECT count(*) AS n, count(*) AS ids FROM customer")
def random_ids(spark, sf):
    appended = S.append_random_id(table(spark, sf, "customer"))
    return appended.agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("ids"))


@query(
    "rows_by_year_csv",
    """SELECT o_orderkey, o_orderpriority, '"' || o_orderstatus || '", x' AS quoted, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def rows_by_year_csv(spark, sf):
    root = fresh_dir(spark, "csv")
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.concat(F.lit('"'), "o_orderstatus", F.lit('", x')).alias("quoted"),
        F.year("o_orderdate").alias("year"),
    )
    S.write_csv_by(rows, root, "year", ["o_orderkey"])
    schema = "o_orderkey bigint, o_orderpriority string, quoted string, year int"
    return spark.read.schema(schema).option("escape", '"').csv(root)


@query(
    "csv_by_header",
    "SELECT c_mktsegment, CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer",
)
def csv_by_header(spark, sf):
    root = fresh_dir(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(root)
    return scan_csv(spark, root, ["c_mktsegment", "c_custkey"])


@query(
    "page_texts",
    f"""
    SELECT source, year, href, arg_max(o_custkey, seq) AS o_custkey, max(seq) AS seq FROM ({LINKS_SQL})
    GROUP BY source, year, href""",
)
def page_texts(spark, sf):
    """Texts rewritten on every visit: the last one stays."""
    root = fresh_dir(spark, "texts")
    last = S.last_write(order_links(spark, sf), ["source", "year", "href"], ["seq"])
    S.write_layout(last, root, ["source", "year"], ["seq"])
    return spark.read.parquet(root).select("source", "year", "href", "o_custkey", "seq")


@query(
    "layout_one_site",
    f"SELECT seq, href, year FROM ({LINKS_SQL}) WHERE source = '4-NOT SPECIFIED' AND year = 1998",
)
def layout_one_site(spark, sf):
    """One site and year out of the layout: only its folder is opened."""
    root = fresh_dir(spark, "layout")
    S.write_layout(order_links(spark, sf), root, ["source", "year"], ["seq"])
    return spark.read.parquet(root).where("source = '4-NOT SPECIFIED' AND year = 1998").select("seq", "href", "year")


@query(
    "held_files",
    "SELECT DISTINCT o_orderstatus AS category, CAST(year(o_orderdate) AS VARCHAR) AS year, true AS held FROM orders",
)
def held_files(spark, sf):
    """Folders with files below a written layout, from the file listing alone."""
    root = fresh_dir(spark, "held")
    rows = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("category"), F.year("o_orderdate").alias("year"))
    S.write_layout(rows, root, ["category", "year"], ["o_orderkey"])
    files = scan_held(spark, root).where(F.endswith("file_name", F.lit(".parquet")))
    return files.groupBy("category", "year").agg((F.min("length") > 0).alias("held"))


BUNDLE_SQL = """
    SELECT n_name, o_orderkey, CAST(o_custkey AS BIGINT) AS length FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def ticker_files(spark, sf):
    """Orders as files of their customer's nation."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    named = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    named = named.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("n_name", "o_orderkey", F.col("o_custkey").alias("length"))


@query(
    "bundles",
    f"""
    SELECT n_name, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS bytes, 'DEF_14A/' || n_name AS address
    FROM ({BUNDLE_SQL}) GROUP BY n_name""",
)
def bundles(spark, sf):
    return S.bundle(ticker_files(spark, sf), "n_name", "length")


@query("bundled_files", BUNDLE_SQL)
def bundled_files(spark, sf):
    root = fresh_dir(spark, "bundles")
    S.write_bundles(ticker_files(spark, sf), root, "n_name", "o_orderkey")
    return spark.read.parquet(root).select("n_name", "o_orderkey", "length")


@query("ensured_target", "SELECT c_custkey, c_name FROM customer")
def ensured_target(spark, sf):
    """Created once, left alone the second time, filled and read."""
    asked = f"Regmill_Documents_{uuid.uuid4().hex}"
    for _ in range(2):
        name = S.ensure_target(spark, asked, "c_custkey bigint, c_name string", fresh_dir(spark, "table"))
    table(spark, sf, "customer").select("c_custkey", "c_name").write.insertInto(name)
    return spark.table(name)


PLACED_SQL = "SELECT o_orderstatus AS site, CAST(year(o_orderdate) AS INTEGER) AS year, 'f' || o_orderkey AS file_name, o_custkey, o_orderkey FROM orders"
PLACE = ["site", "year"]


def placed_files(spark, sf):
    """Orders as files of a site and year."""
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("site"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("f"), "o_orderkey").alias("file_name"),
        "o_custkey",
        "o_orderkey",
    )


@query(
    "layout_written_twice",
    f"""
    SELECT site, year, file_name, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS content,
           CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS load
    FROM ({PLACED_SQL})""",
)
def layout_written_twice(spark, sf):
    """One site and year filled by two loads: the second brings everything again with other contents, the first is started
    again after it. Files that were there keep theirs, nothing is lost or doubled."""
    root = fresh_dir(spark, "placed")
    files = placed_files(spark, sf).select(*PLACE, "file_name", F.col("o_custkey").alias("content"), "o_orderkey")
    for token in ("first", "second", "first", "second"):
        part = files.where("o_orderkey % 3 = 0") if token == "first" else files.withColumn("content", F.col("content") + 1)
        layout.write_load(part, root, token, PLACE, "file_name", ["o_orderkey"])
    held = layout.read_layout(spark, root, files.schema, PLACE, "file_name")
    return held.select(*PLACE, "file_name", "content", "load")


@query(
    "texts_written_again",
    f"""
    SELECT site, year, file_name, o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS content
    FROM ({PLACED_SQL}) WHERE site = 'F' AND year = 1998""",
)
def texts_written_again(spark, sf):
    """Texts of a second load stand in for those of the first; one site and year opens its folders only."""
    root = fresh_dir(spark, "texts")
    files = placed_files(spark, sf).select(*PLACE, "file_name", F.col("o_custkey").alias("content"), "o_orderkey")
    again = files.where("o_orderkey % 3 = 0").withColumn("content", F.col("content") + 1)
    for token, part in (("one", files), ("two", again)):
        layout.write_load(part, root, token, PLACE, "file_name", ["o_orderkey"], wins=layout.LAST)
    held = layout.read_layout(spark, root, files.schema, PLACE, "file_name", wins=layout.LAST)
    return held.where("site = 'F' AND year = 1998").select(*PLACE, "file_name", "content")


@query(
    "manifest_counts",
    f"SELECT site, year, count(*) AS n_files, true AS sized FROM ({PLACED_SQL}) GROUP BY site, year",
)
def manifest_counts(spark, sf):
    """Files held per site and year, from the manifest alone."""
    root = fresh_dir(spark, "manifest")
    files = placed_files(spark, sf)
    for part in (0, 1):
        layout.write_load(files.where(F.col("o_orderkey") % 2 == part), root, f"part {part}", PLACE, "file_name", ["o_orderkey"])
    held = layout.manifest(spark, root, [files.schema[c] for c in PLACE], "file_name")
    return held.groupBy(*PLACE).agg(F.count("*").alias("n_files"), (F.min("size") > 0).alias("sized"))


@query(
    "index_after_compaction",
    """
    SELECT o_custkey, arg_max(o_orderkey, (year(o_orderdate), o_orderkey)) AS o_orderkey,
           arg_max(o_orderstatus, (year(o_orderdate), o_orderkey)) AS o_orderstatus FROM orders GROUP BY o_custkey""",
)
def index_after_compaction(spark, sf):
    """A load per year, merged whenever four are open; old versions and merged writes are removed."""
    root = fresh_dir(spark, "compacted")
    dated = table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    first, last = dated.agg(F.min("y"), F.max("y")).first()
    for load, year in enumerate(range(first, last + 1)):
        S.append_batch(dated.where(F.col("y") == year).select("o_custkey", "o_orderkey", "o_orderstatus"), root, 0, load)
        S.compact_after(spark, root, ["o_custkey"], ["o_orderkey"], writes=4)
    S.expire(spark, root, versions=1)
    return S.read_index(spark, root, ["o_custkey"], ["o_orderkey"]).drop(*S.PLACE)


STATUS_VERSIONS_SQL = """
    SELECT o_custkey, o_orderkey, o_orderstatus,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderkey) AS version FROM orders"""


def loads_with_versions(spark, sf):
    """The orders in three loads by status, the second merged, the last written twice."""
    root = fresh_dir(spark, "versions")
    writes = order_writes(spark, sf).withColumn("url", F.concat(F.lit("/orders/"), "o_orderkey"))
    for load, status in enumerate(["F", "O", "P", "P"]):
        part = writes.where(F.col("o_orderstatus") == status)
        V.append_versions(part, root, 0, ["o_custkey"], ["o_orderkey"], "url", min(load, 2))
        if status == "O":
            S.compact(spark, V.counts_root(root), ["o_custkey"], ["total"])
    return root


@query("versions_over_loads", f"SELECT o_custkey, o_orderkey, version FROM ({STATUS_VERSIONS_SQL})")
def versions_over_loads(spark, sf):
    """Three loads number the writes of an id as one would."""
    return S.read_writes(spark, loads_with_versions(spark, sf)).select("o_custkey", "o_orderkey", "version")


@query(
    "audited_writes",
    f"""
    SELECT o_custkey, '/orders/' || o_orderkey AS url, version,
           '{{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus
           || '","url":"/orders/' || o_orderkey || '"}}' AS record
    FROM ({STATUS_VERSIONS_SQL}) WHERE version > 1""",
)
def audited_writes(spark, sf):
    """Repeated writes of an id with their address and the whole record."""
    root = loads_with_versions(spark, sf)
    return S.read_writes(spark, V.audit_root(root)).select("o_custkey", "url", "version", "record")


VISITS = (1996, 1998, 9999)


@query(
    "live_listing",
    """
    SELECT o_orderpriority AS site, o_orderkey, CAST(CASE WHEN year(o_orderdate) <= 1996 THEN 1
           WHEN year(o_orderdate) <= 1998 THEN 2 ELSE 3 END AS INTEGER) AS run FROM orders""",
)
def live_listing(spark, sf):
    """A listing visited three times, each time all of it and the newest first: each row is taken on the first visit that shows it."""
    root, seen, state = (fresh_dir(spark, n) for n in ("live-index", "listing", "live-marks"))
    place = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * (1 << 40) + F.col("o_orderkey")
    listing = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("site"),
        F.concat(F.lit("Release "), "o_orderkey").alias("title"),
        (-place).alias("pos"),
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
    )
    for visit, last in enumerate(VISITS, 1):
        shown = listing.where(F.col("year") <= last).drop("year").withColumn("run", F.lit(visit))
        shown.write.mode("append").parquet(seen)
        stream = spark.readStream.schema(shown.schema).parquet(seen)
        run_live(stream, root, state, ["site"], "run", "title", "pos", lambda rows: rows).awaitTermination()
    return S.read_writes(spark, root).select("site", "o_orderkey", "run")
