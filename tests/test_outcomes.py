"""Outcomes counted by the job that writes them, pages joined in their buckets, places of held files."""

import pytest
from pyspark.sql import functions as F

from regmill.operators import links as L
from regmill.operators import outcomes as O
from regmill.operators import page_store as P
from regmill.rules import local_frame
from regmill.sources.readers import scan_held


def test_counts_and_parts_come_from_one_job(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(0, 1000, 1, 8).withColumn("text", F.when(F.col("id") % 10 > 0, F.repeat(F.lit("x"), (F.col("id") % 7).cast("int"))))
    df = df.mapInArrow(counted, df.schema)
    checks = {"no text": F.col("text").isNotNull(), "empty": F.length("text") > 0, "never": F.lit(True)}
    done = O.write_outcomes(df, str(tmp_path / "out"), checks, held=F.col("id") < 100)
    rows = [(i, "no text" if i % 10 == 0 else "empty" if i % 7 == 0 else "already held" if i < 100 else "good") for i in range(1000)]
    want = {name: sum(o == name for _, o in rows) for name in [*checks, "already held", "good"]}
    assert done.counts == want and want["never"] == 0
    assert reads.value == 1000
    assert sorted(map(tuple, done.bad.select("id", "reason").collect())) == [r for r in rows if r[1] != "good"]
    assert sorted(r.id for r in done.good.collect()) == [i for i, o in rows if o == "good"]
    assert done.good.columns == df.columns


def test_outcomes_of_edges(spark, tmp_path):
    df = local_frame(spark, [(1, None), (2, True), (3, False)], "id int, ok boolean")
    # a null check fails, a null in held is not held
    done = O.write_outcomes(df, str(tmp_path / "a"), {"not ok": F.col("ok")}, held=F.lit(None).cast("boolean"))
    assert done.counts == {"not ok": 2, "already held": 0, "good": 1}
    none = O.write_outcomes(df.where("false"), str(tmp_path / "b"), {"not ok": F.col("ok")})
    assert none.counts == {"not ok": 0, "good": 0} and none.good.count() == none.bad.count() == 0
    with pytest.raises(ValueError):
        O.write_outcomes(df.withColumn("outcome", F.lit(1)), str(tmp_path / "c"), {"x": F.col("ok")})
    with pytest.raises(ValueError):
        O.write_outcomes(df, str(tmp_path / "d"), {"good": F.col("ok")})


def nodes(plan):
    yield plan
    children = plan.children() if plan.nodeName() != "AdaptiveSparkPlan" else None
    if children is None:
        yield from nodes(plan.executedPlan())
    else:
        for i in range(children.size()):
            yield from nodes(children.apply(i))


def moved(df):
    """(exchanges, those with a stored table below them, stored tables read by bucket) of a plan."""
    plan = list(nodes(df._jdf.queryExecution().executedPlan()))
    exchanges = [n for n in plan if "Exchange" in n.nodeName()]
    return len(exchanges), sum("FileScan" in n.toString() for n in exchanges), sum(n.nodeName().startswith("Scan parquet") and "Bucketed: true" in n.toString() for n in plan)


def test_joins_with_stored_pages_move_no_page(spark, tmp_path):
    pages = spark.range(300).select(
        F.concat(F.lit("/p/"), "id").alias("url"), F.concat(F.lit('<p><a href="/d/'), "id", F.lit('.pdf">d</a></p>')).alias("html"), F.lit("page").alias("kind")
    )
    links = spark.range(900).select(F.concat(F.lit("/p/"), F.col("id") % 450).alias("target"), F.col("id").alias("seq"))
    store = P.write_pages(pages, "stored_pages", 8, path=str(tmp_path / "pages"))
    details = P.write_pages(pages.select("url", F.lit("detail").alias("kind")), "stored_details", 8, path=str(tmp_path / "details"))

    followed, plain = P.follow(spark, links, store, ["seq"]), L.follow(links, pages, ["seq"])
    key = ["target", "n_refs", "href", F.col("first_ref.seq").alias("seq")]
    assert sorted(map(str, followed.select(*key).collect())) == sorted(map(str, plain.select(*key).collect()))
    assert followed.count() == 300

    lost = P.unmatched(spark, links, store)
    assert sorted(map(str, lost.collect())) == sorted(map(str, L.unmatched(links, pages).collect()))
    assert lost.count() == 150

    merged = P.merge_details(spark, store, details)
    assert merged.count() == 300 and {r.kind for r in merged.collect()} == {"detail"}

    # links are dealt out by key to be counted and once more where the store has other buckets; pages never
    assert moved(followed) == (2, 0, 1)
    assert moved(P.unmatched(spark, links, store)) == (1, 0, 1)
    assert moved(P.merge_details(spark, store, details)) == (0, 0, 2)
    spark.sql("DROP TABLE stored_pages")
    spark.sql("DROP TABLE stored_details")


def test_places_of_held_files(spark, tmp_path):
    want = {
        "fcc/f.pdf": ("fcc", None, None),
        "fcc/2020/f.pdf": ("fcc", None, "2020"),
        "fcc/part c/2020/f 1.pdf": ("fcc", "part c", "2020"),
        "fcc/orders/g.pdf": ("fcc", "orders", None),
        "fcc/orders/old/2019/g.pdf": ("fcc", "orders/old", "2019"),
        "site=a%3Ab/category=x+y/year=2021/h.pdf": ("a:b", "x+y", "2021"),
        "occ/year=__HIVE_DEFAULT_PARTITION__/h.pdf": ("occ", None, None),
        "top.pdf": (None, None, None),
    }
    for path in want:
        file = tmp_path / "held" / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"x" * len(path))
    for root in (str(tmp_path / "held"), str(tmp_path / "held") + "/"):
        got = {r.path.split("/held/")[1]: r for r in scan_held(spark, root).collect()}
        assert {p: (r.site, r.category, r.year) for p, r in got.items()} == want
        assert all(r.file_name == p.rpartition("/")[2] and r.length == len(p) for p, r in got.items())
