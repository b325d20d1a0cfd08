"""The pipeline's stages against plain Python on the smallest tables."""

import os
import sys
from collections import defaultdict

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    results = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        results[name] = docs.collect()
        if k < 4:
            assert docs.columns == columns
    quality, exact, near, mixed, tokens = results.values()

    failed = {d for d, r in before.items() if brute.quality_signals(r.text)[-1]}
    kept = {r.doc_id for r in quality}
    assert not kept & failed
    good = [d for d, q in labels.items() if q == 1 and d in before and d not in failed]
    assert len(kept & set(good)) >= 0.98 * len(good)

    last = {}
    for r in quality:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(last.values())

    classes = brute.shingle_components([(r.doc_id, r.text) for r in exact], 5, 80)
    assert sorted(r.doc_id for r in near) == sorted(d for d, (_, c) in classes.items() if d == c)

    copies = defaultdict(int)
    for r in mixed:
        copies[r.doc_id] += 1
    assert set(copies) <= {r.doc_id for r in near} and max(copies.values()) <= 2
    assert len(tokens) == len(mixed) and all(r.decoded_equal for r in tokens)
    assert all(len(r.ids) == 4 * r.n_tokens for r in tokens)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
