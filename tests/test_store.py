import glob
import os
from types import SimpleNamespace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill import session
from regmill.operators import links as L
from regmill.operators import store as S
from regmill.rules import local_frame
from regmill.sources.readers import scan_csv, scan_json, scan_manifest, scan_pages
from regmill.streaming.incremental import run_incremental

WRITES = st.lists(st.tuples(st.sampled_from("aaaabc"), st.integers(0, 200), st.text("xyz", max_size=2)), max_size=30, unique_by=lambda r: r[1])
SCHEMA = "id string, seq bigint, body string"


def rows(df):
    return sorted(map(tuple, df.collect()))


@settings(max_examples=10, deadline=None)
@given(WRITES, WRITES)
def test_upsert_is_idempotent_and_last_write_wins(spark, held, batch):
    target = S.last_write(local_frame(spark, held, SCHEMA), ["id"], ["seq"])
    frame = local_frame(spark, batch, SCHEMA)
    once = S.upsert(target, frame, ["id"], ["seq"])
    want = {r[0]: r for r in sorted(held, key=lambda r: r[1])}
    want.update({r[0]: r for r in sorted(batch, key=lambda r: r[1])})
    assert rows(once) == sorted(want.values())
    assert rows(S.upsert(once, frame, ["id"], ["seq"])) == sorted(want.values())


@settings(max_examples=8, deadline=None)
@given(WRITES, st.sampled_from([1, 7, 1000]))
def test_versions_count_writes(spark, writes, chunk):
    got = S.write_versions(local_frame(spark, writes, SCHEMA), ["id"], ["seq"], chunk)
    want, seen = [], {}
    for r in sorted(writes, key=lambda r: r[1]):
        seen[r[0]] = seen.get(r[0], 0) + 1
        want.append((*r, seen[r[0]]))
    assert rows(got) == sorted(want)


def test_not_held_then_append_leaves_nothing(spark):
    targets = local_frame(
        spark, [("s", 1, "f", 3), ("s", 1, "f", 2), ("s", 1, "g", 1), (None, 1, "h", 0)], "site string, year int, file_name string, seq int"
    )
    place = ["site", "year", "file_name"]
    manifest = local_frame(spark, [("s", 1, "g")], "site string, year int, file_name string")
    fresh = L.not_held(targets, manifest, place, ["seq"])
    assert sorted((r.file_name, r.seq) for r in fresh.collect()) == [("f", 2), ("h", 0)]
    named = targets.where("site is not null")
    held = manifest.unionByName(L.not_held(named, manifest, place, ["seq"]).select(*place))
    assert L.not_held(named, held, place, ["seq"]).count() == 0


def test_replayed_batch_counts_once(spark, tmp_path):
    root = str(tmp_path / "index")
    first = local_frame(spark, [("a", 1, "x"), ("b", 2, "y")], SCHEMA)
    second = local_frame(spark, [("a", 1, "z")], SCHEMA)
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        S.append_batch(batch, root, number)
    assert S.read_writes(spark, root).count() == 3
    assert rows(S.read_index(spark, root, ["id"], ["seq"]).select("id", "body")) == [("a", "z"), ("b", "y")]


def test_live_load_keeps_history_and_other_checkpoints(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "index")
    S.append_batch(local_frame(spark, [("old", 1, "x"), ("both", 9, "y")], SCHEMA), root, 0, S.next_load(spark, root))
    local_frame(spark, [("both", 2, "z")], SCHEMA).write.parquet(source)
    for state in ("s1", "s2", "s1"):
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        run_incremental(stream, root, str(tmp_path / state), lambda b: b).awaitTermination()
    assert S.read_writes(spark, root).count() == 4 and S.next_load(spark, root) == 3
    assert rows(S.read_index(spark, root, ["id"], ["seq"]).select("id", "body")) == [("both", "z"), ("old", "x")]


@pytest.mark.parametrize("pieces", [1, 3])
def test_stream_in_pieces_equals_one_batch(spark, tmp_path, pieces):
    source, root, state = (str(tmp_path / n) for n in ("in", "index", "state"))
    data = [(f"k{i % 7}", i, f"b{i}") for i in range(60)]

    def load():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        run_incremental(stream, root, state, lambda b: b.where("seq % 2 = 0")).awaitTermination()

    for p in range(pieces):
        local_frame(spark, data[p::pieces], SCHEMA).write.mode("append").parquet(source)
        load()
    load()  # nothing new: nothing written
    assert len(glob.glob(f"{root}/source=main/load=0/batch=*")) == pieces
    assert S.read_writes(spark, root).count() == 30
    got = S.last_write(S.read_writes(spark, root), ["id"], ["seq"]).select("id", "seq", "body")
    want = {r[0]: r for r in data if r[1] % 2 == 0}
    assert rows(got) == sorted(want.values())


def test_spread_splits_the_hot_folder_and_keeps_all_rows(spark, tmp_path):
    data = [("hot", i) for i in range(1000)] + [("cold", i) for i in range(10)] + [(None, 5)]
    frame = local_frame(spark, data, "site string, i int").repartition(8)
    out = str(tmp_path / "layout")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tiny tasks are merged again
    try:
        S.write_layout(frame, out, ["site"], ["i"], rows_per_file=200)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    counts = {r.site: r["count"] for r in spark.read.parquet(out).groupBy("site").count().collect()}
    assert counts == {"hot": 1000, "cold": 10, None: 1}
    assert len(glob.glob(f"{out}/site=cold/*.parquet")) == 1
    assert len(glob.glob(f"{out}/site=hot/*.parquet")) > 1


def test_csv_by_year_and_header_scan(spark, tmp_path):
    frame = local_frame(spark, [(2001, 'a "q", x', "1"), (2002, "b", None)], "year int, c0 string, c1 string")
    out = str(tmp_path / "csv")
    S.write_csv_by(frame, out, "year", ["c0"])
    assert sorted(os.path.basename(p) for p in glob.glob(f"{out}/year=*")) == ["year=2001", "year=2002"]
    (text,) = [open(p).read() for p in glob.glob(f"{out}/year=2001/*.csv")]
    assert text == '"a ""q"", x",1\n'
    (tmp_path / "t.csv").write_text('NAME,TICKER,X\n"Acme, Inc",ACM,1\n"B ""b""",BBB,2\n')
    (tmp_path / "u.csv").write_text('TICKER,NAME\nACM,"two\nlines"\nBBB,x\n')
    assert [r.NAME for r in scan_csv(spark, str(tmp_path / "u.csv"), ["NAME"]).collect()] == ["two\nlines", "x"]
    got = scan_csv(spark, str(tmp_path / "t.csv"), ["TICKER"])
    assert got.columns == ["TICKER"] and [r.TICKER for r in got.collect()] == ["ACM", "BBB"]


def test_scans(spark, tmp_path):
    pages = local_frame(spark, [("u1", 200, "<p>"), ("u2", 404, "x"), ("u3", 200, None)], "url string, status int, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    assert [r.url for r in scan_pages(spark, str(tmp_path / "pages")).collect()] == ["u1"]
    (tmp_path / "r.json").write_text('{"total": 3, "x": 1}\nbroken\n')
    got = scan_json(spark, str(tmp_path / "r.json"), "total bigint").collect()
    assert [r.total for r in got] == [3, None]
    files = scan_manifest(spark, str(tmp_path / "pages")).where("file_name LIKE '%.parquet'")
    assert files.count() >= 1 and files.where("length <= 0").count() == 0


def test_bundles_targets_and_random_ids(spark, tmp_path):
    files = local_frame(spark, [("A", "p1", 5), ("A", "p2", 6), ("B", "p3", 7)], "ticker string, path string, length bigint")
    assert rows(S.bundle(files, "ticker", "length")) == [("A", 2, 11, "DEF_14A/A"), ("B", 1, 7, "DEF_14A/B")]
    S.write_bundles(files, str(tmp_path / "b"), "ticker", "path")
    assert glob.glob(f"{tmp_path}/b/ticker=A/*.gz.parquet")
    ids = S.append_random_id(files)
    assert ids.select("document_id").distinct().count() == 3
    name = S.ensure_target(spark, "Docs_Test", "id string", str(tmp_path / "t"))
    assert name == "docs_test" and S.ensure_target(spark, "DOCS_TEST", "other int") == name
    assert spark.table(name).columns == ["id"]


def test_outcomes(spark):
    runs = local_frame(spark, [(None, True), (0, False), (3, False)], "n_files int, failed boolean")
    assert [r.outcome for r in L.classify(runs).collect()] == ["error", "no files", "files"]
    filed = local_frame(spark, [("2021-12-31",), ("2022-01-01",), ("2022-12-31",), ("2023-01-01",)], "filed string").selectExpr("date(filed) filed")
    assert L.filings_between(filed, "2021-12-31", "2023-01-01").count() == 2
    assert L.filings_between(filed, "2021-12-31", "2023-01-01", inclusive=True).count() == 4


def test_deny_list_with_null_and_repeats(spark):
    links = local_frame(spark, [("enforce", "/a.htm"), ("enforce", "/b.htm"), ("admin", "/a.htm"), ("enforce", None)], "site string, href string")
    denied = local_frame(spark, [("enforce", "/a.htm"), ("enforce", "/a.htm"), ("enforce", None)], "site string, value string")
    got = L.deny_links(links, denied, ["site"]).collect()
    assert sorted((r.site, r.href or "") for r in got) == [("admin", "/a.htm"), ("enforce", ""), ("enforce", "/b.htm")]


def test_follow_opens_a_hot_page_once(spark):
    links = spark.range(500).select(F.lit("/hot").alias("target"), F.col("id").alias("seq"))
    pages = local_frame(spark, [("/hot", '<a href="/d.pdf">d</a>'), ("/cold", '<a href="/e.pdf">e</a>')], "url string, html string")
    rows_ = L.follow(links, pages, ["seq"]).collect()
    assert [(r.target, r.first_ref.seq, r.n_refs, r.href) for r in rows_] == [("/hot", 0, 500, "/d.pdf")]
    assert [r.target for r in L.unmatched(links, pages.where("url = '/cold'")).collect()] == ["/hot"]


def cluster(**conf):
    context = SimpleNamespace(master="spark://host:7077", applicationId="app")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_follows_the_session(spark):
    assert session.fresh_dir(cluster(**{session.CHECKPOINT_CONF: "hdfs://x/cp/"}), "links").startswith("hdfs://x/cp/links-")
    with pytest.raises(ValueError, match=session.CHECKPOINT_CONF):
        session.shared_root(cluster())
    assert session.written(spark.range(3).toDF("id"), "kept").count() == 3


def test_written_in_few_files(spark):
    many = spark.range(0, 40, 1, 10)
    with session.scratch(spark) as noted:
        tables = [session.written(many, "many"), session.written(many, "few", 3), session.written(many, "all", 20)]
    files = [sum(f.endswith(".parquet") for f in os.listdir(p)) for p in noted.paths]
    assert files == [10, 3, 10] and [t.agg({"id": "sum"}).first()[0] for t in tables] == [780] * 3
    noted.drop()


def test_scratch_tables_go_when_their_owner_is_done(spark):
    before = session.written(spark.range(2).toDF("id"), "before")
    with session.scratch(spark) as noted:
        inside = session.written(spark.range(3).toDF("id"), "inside")
    after = session.written(spark.range(4).toDF("id"), "after")
    assert len(noted.paths) == 1 and inside.count() == 3
    place = noted.paths[0]
    noted.drop()
    noted.drop()
    assert not os.path.exists(place) and before.count() + after.count() == 6
