"""Bloom filters of held places: never a miss, few false hits, and the exact rows after them."""

from pyspark.sql import functions as F

from regmill.operators import bloom
from regmill.operators import links as L
from regmill.rules import local_frame

SCHEMA = "site string, year int, file_name string, seq int"
PLACE = ["site", "year", "file_name"]


def test_filter_has_no_false_negative_and_few_false_hits(spark):
    keys = spark.range(20_000).select(F.when(F.col("id") % 7 > 0, F.col("id").cast("string")).alias("a"), F.col("id").alias("b"))
    blocks = bloom.block_count(20_000)
    assert blocks == 10 and bloom.filter_bytes(20_000) == 40_960
    table = bloom.build(keys, ["a", "b"], blocks).collect()
    assert len(table) == blocks and all(len(r.bits) == bloom.BLOCK_BITS // 8 for r in table)
    frame = bloom.build(keys, ["a", "b"], blocks)
    assert bloom.look_up(keys, ["a", "b"], frame, blocks).where("not maybe").count() == 0
    others = keys.select("a", (F.col("b") + 1_000_000).alias("b"))
    assert bloom.look_up(others, ["a", "b"], frame, blocks).where("maybe").count() < 20_000 * 0.02


def test_empty_filter_holds_nothing(spark):
    keys = spark.range(3)
    frame = bloom.build(keys.where("id < 0"), ["id"], 1)
    assert bloom.look_up(keys, ["id"], frame, 1).where("maybe").count() == 0


def test_filtered_equals_exact(spark):
    targets = [("s", y, f"f{i}", i * 10 + y) for i in range(60) for y in range(3)] + [(None, None, "h", 1), (None, 1, "h", 2), ("s", 0, "f0", 999)]
    held = [("s", 1, f"f{i}") for i in range(0, 60, 2)] + [(None, None, "h"), ("t", 5, "g")] * 2
    targets = local_frame(spark, targets, SCHEMA)
    manifest = local_frame(spark, held, "site string, year int, file_name string")
    want = sorted(map(str, L.not_held(targets, manifest, PLACE, ["seq"]).collect()))
    assert len(want) == 60 * 3 - 30 + 1
    for bound in (bloom.MAX_BYTES, 0):
        got = L.not_held_filtered(targets, manifest, PLACE, ["seq"], max_bytes=bound)
        assert got.columns == targets.columns
        assert sorted(map(str, got.collect())) == want
    assert sorted(map(str, L.not_held_filtered(targets, manifest.where("false"), PLACE, ["seq"]).collect())) == sorted(
        map(str, L.not_held(targets, manifest.where("false"), PLACE, ["seq"]).collect())
    )
    # a wider type of one column: compared exactly, since hashes of int and bigint differ
    wide = manifest.withColumn("year", F.col("year").cast("bigint"))
    assert sorted(map(str, L.not_held_filtered(targets, wide, PLACE, ["seq"]).collect())) == want


def test_manifest_is_not_shuffled(spark, tmp_path):
    """The manifest goes into the filter's aggregate and into one broadcast comparison; of its rows none is exchanged."""
    manifest = spark.range(200_000).select(F.lit("s").alias("site"), (F.col("id") % 20).cast("int").alias("year"), F.concat(F.lit("f"), "id").alias("file_name"))
    manifest.write.parquet(str(tmp_path / "manifest"))
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    new = [("s", i % 20, f"f{i}", i) for i in range(199_900, 200_400)]
    got = L.not_held_filtered(local_frame(spark, new, SCHEMA), manifest, PLACE, ["seq"])
    assert got.count() == 400
    frame = got._jdf.queryExecution().executedPlan()
    rows = shuffled_rows(frame)
    print("rows of each shuffle:", rows)
    assert max(rows) < 2_000


def shuffled_rows(plan):
    """Records written by every exchange of an executed plan."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return out
