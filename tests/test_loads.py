"""Loads into stores: layouts with a manifest, compacted indexes, live marks, running versions."""

import glob
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regmill.operators import folders, layout
from regmill.operators import links as L
from regmill.operators import store as S
from regmill.operators import versions as V
from regmill.rules import local_frame
from regmill.session import shared_root
from regmill.streaming.incremental import load_number
from regmill.streaming.live import above_marks, latest_runs, marked_runs, run_live, state_schema

FILES = "site string, year int, file_name string, body string, seq int"
PLACE = ["site", "year"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def add(spark, root, token, data, **options):
    return layout.write_load(local_frame(spark, data, FILES), root, token, PLACE, "file_name", ["seq"], **options)


def shown(spark, root, **options):
    schema = StructType.fromDDL(FILES)
    return rows(layout.read_layout(spark, root, schema, PLACE, "file_name", **options).drop("load", "seq"))


# --- layouts ----------------------------------------------------------------------------------------------


def test_second_load_of_a_folder_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "l")
    add(spark, root, "one", [("s", 2001, "a.pdf", "a", 0)])
    # what is fetched next is what is not held, as in the collection flow
    wanted = local_frame(spark, [("s", 2001, "a.pdf", "A", 0), ("s", 2001, "b.pdf", "b", 0)], FILES)
    place = [*PLACE, "file_name"]
    held = layout.manifest(spark, root, [wanted.schema[c] for c in PLACE], "file_name")
    layout.write_load(L.not_held(wanted, held, place, ["seq"]), root, "two", PLACE, "file_name", ["seq"])
    assert shown(spark, root) == [("s", 2001, "a.pdf", "a"), ("s", 2001, "b.pdf", "b")]


def test_plain_layouts_add_files_too(spark, tmp_path):
    root = str(tmp_path / "p")
    for name in ("a", "b"):
        S.write_layout(local_frame(spark, [("s", 1, name, "", 0)], FILES), root, PLACE, ["seq"])
        S.write_csv_by(local_frame(spark, [(1, name)], "year int, c0 string"), root + "-csv", "year", ["c0"])
    assert spark.read.parquet(root).count() == 2 and spark.read.csv(root + "-csv").count() == 2


@pytest.mark.parametrize("wins,want", [("first", "one"), ("last", "three")])
def test_order_of_loads_decides(spark, tmp_path, wins, want):
    root = str(tmp_path / "l")
    for k, body in enumerate(("one", "two", "three")):
        assert add(spark, root, body, [("s", None, "f", body, 1), (None, 5, "g", "own " + body, k)], wins=wins) == k
    assert shown(spark, root, wins=wins) == [(None, 5, "g", "own " + want), ("s", None, "f", want)]


def test_rows_of_one_file_in_a_load(spark, tmp_path):
    data = [("s", 1, "f", "low", 1), ("s", 1, "f", "high", 2)]
    add(spark, str(tmp_path / "a"), "t", data)
    add(spark, str(tmp_path / "b"), "t", data, wins="last")
    assert shown(spark, str(tmp_path / "a")) == [("s", 1, "f", "low")]
    assert shown(spark, str(tmp_path / "b"), wins="last") == [("s", 1, "f", "high")]


def test_load_that_died_starts_over_and_a_finished_one_is_left_alone(spark, tmp_path):
    root = str(tmp_path / "l")
    add(spark, root, "one", [("s", 1, "a", "x", 0)])
    data = [("s", 1, "b", "x", 0), ("t/u=v%", 2, "c", "x", 0)]
    add(spark, root, "two", data)
    # the manifest is what makes a load visible
    for path in glob.glob(f"{root}/manifest/load=1/*") + glob.glob(f"{root}/manifest/load=1/.*"):
        os.remove(path)
    assert shown(spark, root) == [("s", 1, "a", "x")] and layout.unfinished(spark, root) == [1]
    assert add(spark, root, "three", [("s", 1, "d", "x", 0)]) == 2
    assert add(spark, root, "two", data) == 1 and layout.unfinished(spark, root) == []
    before = sorted(glob.glob(f"{root}/data/**/*.parquet", recursive=True))
    assert add(spark, root, "two", data) == 1
    assert sorted(glob.glob(f"{root}/data/**/*.parquet", recursive=True)) == before
    assert [r[2] for r in shown(spark, root)] == ["a", "b", "d", "c"]


def test_a_place_opens_its_folders_only(spark, tmp_path):
    root = str(tmp_path / "l")
    for k in range(3):
        add(spark, root, f"t{k}", [(s, y, f"{s}{y}{k}", "x", 0) for s in "ab" for y in (1, 2)])
    held = layout.read_layout(spark, root, StructType.fromDDL(FILES), PLACE, "file_name").where("site = 'a' AND year = 2")
    assert held.count() == 3
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(site" in plan


def test_empty_loads(spark, tmp_path):
    root = str(tmp_path / "l")
    assert shown(spark, root) == []
    add(spark, root, "none", [])
    assert shown(spark, root) == []
    add(spark, root, "some", [("s", 1, "a", "x", 0)])
    add(spark, root, "again", [("s", 1, "a", "y", 0)])
    assert shown(spark, root) == [("s", 1, "a", "x")]


def test_claims_are_taken_once(spark, tmp_path):
    root = str(tmp_path / "c")
    assert [folders.claim_load(spark, root, t) for t in ("a", "b", "a", "c")] == [0, 1, 0, 2]
    assert not folders.create_once(spark, f"{root}/_loads/2", "other") and folders.text_of(spark, f"{root}/_loads/2") == "c"


def test_streams_of_one_root_and_a_removed_checkpoint(spark, tmp_path):
    root, state = str(tmp_path / "i"), str(tmp_path / "s1")
    assert load_number(spark, root, state) == 0
    os.mkdir(state)
    assert load_number(spark, root, state) == 0 and load_number(spark, root, str(tmp_path / "s2")) == 1
    os.rmdir(state)
    assert load_number(spark, root, state) == 2


# --- index ------------------------------------------------------------------------------------------------

WRITES = "id string, seq bigint, body string"


def index(spark, root):
    return rows(S.read_index(spark, root, ["id"], ["seq"]).select("id", "seq", "body"))


def test_compaction_keeps_the_index_and_bounds_the_folders(spark, tmp_path):
    root, want, most = str(tmp_path / "i"), {}, 0
    for load in range(20):
        data = [(f"k{(load * 7 + i) % 11}", load * 10 + i, f"{load}.{i}") for i in range(5)] + [(None, load, "n")]
        S.append_batch(local_frame(spark, data, WRITES), root, 0, load, "a/b" if load % 2 else "main")
        want |= {r[0]: r for r in sorted(data, key=lambda r: r[1])}
        before = index(spark, root)
        S.compact_after(spark, root, ["id"], ["seq"], 4)
        assert index(spark, root) == before
        most = max(most, len(S.pending_writes(spark, root)))
        if load % 8 == 7:
            assert S.expire(spark, root, versions=1) > 0
    assert most < 4 and index(spark, root) == sorted(want.values(), key=lambda r: (r[0] is not None, r[0]))
    assert S.next_load(spark, root) == 20
    assert len(glob.glob(f"{root}/source=*/load=*/batch=*")) < 20


def test_replayed_and_late_batches_after_a_compaction(spark, tmp_path):
    root = str(tmp_path / "i")
    frames = [local_frame(spark, [("a", k, f"b{k}"), (f"own{k}", k, "x")], WRITES) for k in range(3)]
    for k in (1, 2):
        S.append_batch(frames[k], root, k, 0)
    S.compact(spark, root, ["id"], ["seq"])
    assert S.compact(spark, root, ["id"], ["seq"]) is None
    S.append_batch(frames[2], root, 2, 0)  # replayed: the version has it
    assert S.pending_writes(spark, root) == []
    S.append_batch(frames[0], root, 0, 0)  # late, with a smaller number: it loses where ids meet
    want = [("a", 2, "b2"), ("own0", 0, "x"), ("own1", 1, "x"), ("own2", 2, "x")]
    assert index(spark, root) == want
    S.compact(spark, root, ["id"], ["seq"])
    assert index(spark, root) == want
    S.expire(spark, root, 1)
    S.append_batch(frames[2], root, 2, 0)  # replayed after its folder was removed
    assert index(spark, root) == want


def test_version_without_pointer_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "i")
    S.append_batch(local_frame(spark, [("a", 1, "x")], WRITES), root, 0, 0)
    version = S.compact(spark, root, ["id"], ["seq"])
    os.remove(f"{root}/_pointers/{version}")  # a compaction that died before its last step
    assert index(spark, root) == [("a", 1, "x")]


def test_upsert_ranks_the_batch_once(spark):
    target = local_frame(spark, [("a", 0, "old"), (None, 0, "none")], WRITES)
    batch = local_frame(spark, [("a", 2, "new"), ("a", 1, "mid"), (None, 5, "some"), ("b", 1, "b")], WRITES)
    got = S.upsert(target, batch, ["id"], ["seq"])
    assert rows(got) == [(None, 5, "some"), ("a", 2, "new"), ("b", 1, "b")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1


# --- live listings ----------------------------------------------------------------------------------------

LISTING = "source string, run int, pos int, title string"


def visits(data):
    """New titles by taking rows from the top of each visit until the head of the visit before."""
    out, mark = [], {}
    for source, run in sorted({(r[0], r[1]) for r in data}, key=lambda x: x[1]):
        listed = sorted((r for r in data if r[:2] == (source, run)), key=lambda r: r[2])
        for r in listed:
            if mark.get(source) is not None and r[3] == mark[source]:
                break
            out.append(r)
        heads = [r[3] for r in listed if r[3] is not None]
        if heads:
            mark[source] = heads[0]
    return sorted(out, key=str)


def listing_rows():
    data = []
    for run, newest in enumerate((4, 9, 9, 15), 1):
        data += [("s", run, newest - k, f"t{k}") for k in range(newest + 1)]
        data += [("gone", run, k, f"g{run}.{k}") for k in range(3)]
        data += [(None, run, k, f"n{run - k}") for k in range(3)]
    return [*data, ("s", 4, -1, None)]


@pytest.mark.parametrize("pieces", [1, 3])
def test_stream_stops_at_the_mark_of_the_visit_before(spark, tmp_path, pieces):
    root, seen, state = (str(tmp_path / n) for n in ("i", "listing", "state"))
    data = listing_rows()
    for run in range(1, 5):
        visit = sorted((r for r in data if r[1] == run), key=lambda r: (r[2], str(r[0])))
        # the mark's piece may come first: then what lies below it in later pieces is left out
        for p in range(pieces):
            size = -(-len(visit) // pieces)
            local_frame(spark, visit[p * size : (p + 1) * size], LISTING).coalesce(1).write.mode("append").parquet(seen)
            stream = spark.readStream.schema(LISTING).option("maxFilesPerTrigger", 1).parquet(seen)
            run_live(stream, root, state, ["source"], "run", "title", "pos", lambda b: b.withColumnRenamed("source", "site")).awaitTermination()
    held = S.read_writes(spark, root)
    got = sorted(map(tuple, held.select("site", "run", "pos", "title").collect()), key=str)
    assert got == visits(data)
    assert held.select("load").distinct().count() == 1


def test_batch_form_equals_the_visits_one_by_one(spark):
    data = listing_rows()
    frame = local_frame(spark, data, LISTING)
    schema = state_schema(frame.schema, ["source"], "run", "title", "pos")
    names = (["source"], "run", "title", "pos")

    def cut(part, state):
        runs = marked_runs(part, state, *names)
        return list(map(tuple, above_marks(part, runs, ["source"], "run", "pos").collect())), latest_runs(runs, ["source"]).select(*schema.names)

    none = spark.createDataFrame([], schema)
    assert sorted(cut(frame, none)[0], key=str) == visits(data)
    got, state = [], none
    for low, high in ((1, 2), (3, 4)):
        new, after = cut(frame.where(F.col("run").between(low, high)), state)
        got += new
        state = spark.createDataFrame(after.collect(), schema)
    assert sorted(got, key=str) == visits(data)


def test_live_load_starts_at_the_mark_of_the_index_and_survives_a_replay(spark, tmp_path):
    root, seen, state = (str(tmp_path / n) for n in ("i", "listing", "state"))
    shown_ = [("s", 1, k, f"t{9 - k}") for k in range(10)]
    local_frame(spark, shown_, LISTING).write.parquet(seen)
    marks = local_frame(spark, [("s", "t6")], "source string, mark string")

    def load(m):
        stream = spark.readStream.schema(LISTING).parquet(seen)
        run_live(stream, root, state, ["source"], "run", "title", "pos", lambda b: b.drop("source"), marks=m).awaitTermination()

    load(marks)
    want = [(1, 0, "t9"), (1, 1, "t8"), (1, 2, "t7")]
    assert rows(S.read_writes(spark, root).select("run", "pos", "title")) == want
    # the driver died after the batch was written and before the stream noted it: the batch comes again
    os.remove(f"{state}/commits/0")
    for crc in glob.glob(f"{state}/commits/.0.crc"):
        os.remove(crc)
    load(local_frame(spark, [("s", "t9")], "source string, mark string"))
    assert rows(S.read_writes(spark, root).select("run", "pos", "title")) == want


# --- versions ---------------------------------------------------------------------------------------------


@settings(max_examples=3, deadline=None)
@given(st.lists(st.sampled_from(["a", "a", "b", None]), min_size=1, max_size=12), st.integers(1, 3))
def test_versions_of_loads_are_those_of_one(spark, tmp_path_factory, ids, loads):
    root = str(tmp_path_factory.mktemp("v") / "i")
    data = [(x, k, f"/d/{k}") for k, x in enumerate(ids)]
    size, want, seen = -(-len(data) // loads), [], {}
    for x, k, url in data:
        seen[x] = seen.get(x, 0) + 1
        want.append((x, k, url, seen[x]))
    schema = "id string, seq int, url string"
    for load in range(loads):
        part = local_frame(spark, data[load * size : (load + 1) * size], schema)
        for _ in range(2):  # every load is replayed
            V.append_versions(part, root, 0, ["id"], ["seq"], "url", load)
    held = S.read_writes(spark, root).select("id", "seq", "url", "version")
    key = lambda r: (r[0] is not None, r[0] or "", r[1])
    assert sorted(map(tuple, held.collect()), key=key) == sorted(want, key=key)
    audit = S.read_writes(spark, V.audit_root(root)).collect()
    assert sorted(r.url for r in audit) == sorted(w[2] for w in want if w[3] > 1)
    assert all(f'"url":"{r.url}"' in r.record for r in audit)


def test_versions_compute_a_batch_once(spark, tmp_path):
    """A batch that is dear to compute is not computed again for its counts; its scratch table goes."""
    asked = spark.sparkContext.accumulator(0)

    def place(k):
        asked.add(1)
        return k

    ids = local_frame(spark, [(f"k{k % 30}", k, f"/d/{k}") for k in range(40)], "id string, seq int, url string")
    batch = ids.withColumn("seq", F.udf(place, "int")("seq"))
    before = set(glob.glob(f"{shared_root(spark)}/batch-*"))
    V.append_versions(batch, str(tmp_path / "i"), 0, ["id"], ["seq"], "url")
    assert asked.value == 40
    assert set(glob.glob(f"{shared_root(spark)}/batch-*")) == before
    assert S.read_writes(spark, V.audit_root(str(tmp_path / "i"))).count() == 10
