"""Order-dependent steps against plain loops, with chunks small enough that state crosses many of them."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regmill.operators import ordered as O
from regmill.operators.scale import deal_out, first_by
from regmill.rules import local_frame

ROWS = st.lists(
    st.tuples(st.sampled_from("aaaab"), st.integers(-30, 60), st.one_of(st.none(), st.sampled_from("xyz"))),
    max_size=60,
    unique_by=lambda r: (r[0], r[1]),
)
SCHEMA = "site string, seq bigint, text string"


def ordered_rows(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None)
@given(ROWS, st.sampled_from([1, 4, 1000]))
def test_forward_fill(spark, rows, chunk):
    got = O.forward_fill(local_frame(spark, rows, SCHEMA), "text", ["site"], ["seq"], "parent", chunk)
    want, last = [], {}
    for site, seq, text in ordered_rows(rows):
        last[site] = text if text is not None else last.get(site)
        want.append((site, seq, text, last[site]))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


@settings(max_examples=12, deadline=None)
@given(ROWS, st.sampled_from([1, 4, 1000]), st.booleans())
def test_running_count(spark, rows, chunk, inclusive):
    frame = local_frame(spark, rows, SCHEMA)
    got = O.running_count(frame, F.col("text") == "x", ["site"], ["seq"], "n", inclusive, chunk)
    want, seen = [], {}
    for site, seq, text in ordered_rows(rows):
        before = seen.get(site, 0)
        seen[site] = before + (text == "x")
        want.append((site, seq, text, seen[site] if inclusive else before))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


def assembled_by_loop(rows, closes):
    out, held = [], {}
    for site, seq, text in ordered_rows(rows):
        parts, number = held.get(site, ("", 0))
        parts += text or ""
        if closes(seq):
            out.append((site, number, parts, seq))
            parts, number = "", number + 1
        held[site] = (parts, number)
    return out


@settings(max_examples=12, deadline=None)
@given(ROWS, st.sampled_from([1, 4, 1000]))
def test_assemble_records(spark, rows, chunk):
    got = O.assemble_records(
        local_frame(spark, rows, SCHEMA), ["site"], ["seq"], {"text": F.col("text")}, F.col("seq") % 5 == 0,
        {"closed_at": F.col("seq")}, chunk,
    ).select("site", "record_no", "text", "closed_at")
    assert sorted(map(tuple, got.collect())) == assembled_by_loop(rows, lambda seq: seq % 5 == 0)


def test_one_site_holds_most_rows(spark):
    """A hot group crosses many chunks and still equals the loop."""
    rnd = random.Random(5)
    rows = [("hot", i, rnd.choice([None, None, "x", "y"])) for i in range(3000)]
    rows += [(f"s{i % 40}", i, "z") for i in range(1500)]
    rnd.shuffle(rows)
    frame = local_frame(spark, rows, SCHEMA)
    got = O.assemble_records(
        frame, ["site"], ["seq"], {"text": F.col("text")}, F.col("seq") % 97 == 0, {"closed_at": F.col("seq")}, 64
    ).select("site", "record_no", "text", "closed_at")
    assert sorted(map(tuple, got.collect())) == assembled_by_loop(rows, lambda seq: seq % 97 == 0)


def test_first_seen_scopes(spark):
    rows = [("a", 2, "x"), ("a", 1, "x"), ("b", 3, "x"), ("b", 0, "y")]
    frame = local_frame(spark, rows, SCHEMA)
    run = O.first_seen(frame, ["text"], [], ["seq"]).collect()
    assert sorted(r.seq for r in run) == [0, 1]
    yearly = O.first_seen(frame, ["text"], ["site"], ["seq"]).collect()
    assert sorted(r.seq for r in yearly) == [0, 1, 3]


def test_first_by_limits_before_the_shuffle(spark):
    plan = first_by(spark.range(10).withColumn("k", F.lit(1) * (F.col("id") % 2)), ["k"], [F.col("id")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and text.rindex("WindowGroupLimit") > text.index("Exchange")


MARKED = [("a", 0, "n2"), ("a", 1, "n1"), ("a", 2, "mark"), ("a", 3, "old"), ("a", 4, "mark"), ("b", 0, "mark"), ("c", 0, "c1")]


def test_since_mark(spark):
    listing = local_frame(spark, MARKED, "source string, pos int, title string")
    index = local_frame(
        spark, [("a", 7, "later"), ("a", 1, "mark"), ("b", 1, "mark")], "source string, seq int, title string"
    )
    marks = O.high_water(index, ["source"], "title", ["seq"])
    got = O.since_mark(listing, marks, ["source"], "title", "pos").collect()
    assert sorted((r.source, r.title) for r in got) == [("a", "n1"), ("a", "n2"), ("c", "c1")]
    none = O.since_mark(listing, marks.where("false"), ["source"], "title", "pos")
    assert none.count() == len(MARKED)


@pytest.mark.parametrize("splits", [1, 20])
def test_deal_out_does_as_told(spark, splits):
    dealt = deal_out(spark.range(100, numPartitions=splits), "id", 5)
    assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 100


@pytest.mark.parametrize("chunk", [1, 3])
def test_order_ties_broken_by_second_column(spark, chunk):
    rows = [("a", 1, 0, "p"), ("a", 1, 1, None), ("a", 1, 2, "q"), ("a", 2, 0, None)]
    frame = local_frame(spark, rows, "site string, seq bigint, pos int, text string")
    got = O.forward_fill(frame, "text", ["site"], ["seq", "pos"], "parent", chunk).orderBy("seq", "pos").collect()
    assert [r.parent for r in got] == ["p", "p", "q", "q"]


@pytest.mark.parametrize("chunk", [1, 1000])
def test_null_keys_are_a_group(spark, chunk):
    rows = [(None, 0, "x"), (None, 1, None), (None, 2, "y"), (None, 3, None), ("a", 0, None), ("a", 1, "z")]
    frame = local_frame(spark, rows, SCHEMA)
    filled = O.forward_fill(frame, "text", ["site"], ["seq"], "parent", chunk).collect()
    want = [(None, 0, "x"), (None, 1, "x"), (None, 2, "y"), (None, 3, "y"), ("a", 0, None), ("a", 1, "z")]
    assert {(r.site, r.seq, r.parent) for r in filled} == set(want) and len(filled) == len(want)
    counted = O.running_count(frame, F.lit(True), ["site"], ["seq"], "n", True, chunk).collect()
    assert {(r.site, r.seq, r.n) for r in counted} == {(site, seq, seq + 1) for site, seq, _ in rows}
    made = O.assemble_records(
        frame, ["site"], ["seq"], {"text": F.col("text")}, F.col("seq") % 2 == 1, {"closed_at": F.col("seq")}, chunk
    ).collect()
    assert {(r.site, r.record_no, r.text, r.closed_at) for r in made} == {(None, 0, "x", 1), (None, 1, "y", 3), ("a", 0, "z", 1)}


def test_chunks_follow_the_rows_not_their_order_values(spark):
    """A hot group with values far apart, most of them in one corner, is cut into chunks of like size."""
    skewed = F.when(F.col("id") % 10 == 0, F.col("id") * 10**12).otherwise(F.col("id"))
    rows = spark.range(60_000).select(F.lit("hot").alias("site"), skewed.alias("seq"))
    rows = rows.unionByName(spark.range(50).select(F.concat(F.lit("s"), "id").alias("site"), F.col("id").alias("seq")))
    sizes = {}
    for r in O._chunked(rows, ["site"], ["seq"], 64).groupBy("site", "_chunk").count().collect():
        sizes.setdefault(r.site, []).append(r["count"])
    hot = sorted(sizes.pop("hot"))
    assert len(hot) == O.BOUNDS + 1 and hot[-1] <= 12 * 60_000 / len(hot)
    assert all(len(x) <= 2 for x in sizes.values())


@pytest.mark.parametrize("chunk", [1, 5, 1000])
def test_order_of_texts_and_nulls(spark, chunk):
    """Order columns need be no numbers; nulls come first."""
    data = [("a", x) for x in ("m", None, "b", "z", "k", "c", "q")] + [(None, "x"), (None, "y")]
    got = O.running_count(local_frame(spark, data, "site string, place string"), F.lit(True), ["site"], ["place"], "n", True, chunk)
    want = [("a", p, n) for n, p in enumerate([None, "b", "c", "k", "m", "q", "z"], 1)] + [(None, "x", 1), (None, "y", 2)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_rows_move_once_to_their_chunk(spark):
    """Bounds and carries are sent to the rows: no join of an ordered step sorts both of its sides."""
    rows = spark.range(1000).select((F.col("id") % 3).alias("site"), F.col("id").alias("seq"), F.lit("x").alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frames = [
            O.running_count(rows, F.lit(True), ["site"], ["seq"], "n", True, 4),
            O.forward_fill(rows, "text", ["site"], ["seq"], "last", 4),
            O.assemble_records(rows, ["site"], ["seq"], {"text": F.col("text")}, F.col("seq") % 5 == 0, {}, 4),
        ]
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in frames]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)


def test_bounds_are_searched_in_halves(spark):
    """A row of a hot group is compared with a few of its bounds, not with all of them."""
    chunked = O._chunked(spark.range(10).withColumn("site", F.lit("hot")), ["site"], ["id"], 4)
    plan = chunked._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(_bounds" not in plan and "aggregate([128,64,32,16,8,4,2,1]" in plan
