"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from lakeaudit.llm import jaccard_join, line_dedup, queries
from tools.compare import normal

from .test_dedup import plain_components, plain_lines

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got, want = queries.QUERIES[name](spark, SF_DIR).toPandas(), db.execute(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


def test_pipeline(spark):
    """Each stage against a plain version, on what the stage before it left."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF_DIR))
        seen.append((before, docs))
    assert all(out.columns == columns for _, out in seen[:-1])
    rows = [[tuple(r) for r in frame.select("doc_id", "text").collect()] for frame, _ in seen] 
    scores = {r.doc_id: r.kept for r in queries.op1_kneser_ney(spark, SF_DIR).collect()}
    assert {r[0] for r in rows[1]} == {i for i, kept in scores.items() if kept}
    assert dict(rows[2]) == {i: t for i, (t, *_) in plain_lines(rows[1], 10).items()}
    root = plain_components(rows[2], 5, 80)
    assert {r[0] for r in rows[3]} == {i for i, (_, r) in root.items() if i == r}
    last = seen[-1][1].collect()
    assert {r.doc_id for r in last} == {r[0] for r in rows[4]} and all(len(r.ids) == r.n_tokens for r in last)
    again = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert again == {r.doc_id: r.decoded_sha256 for r in last}
    assert jaccard_join and line_dedup


def test_pipeline_hands_out_small_batches(spark):
    """Each stage bounds the bytes of a batch for a Python worker, unless the session has its own bound."""
    key, seen = corpus_pipeline.BATCH_SETTING, []
    own = spark.conf.get(key, None)
    stage = corpus_pipeline.in_small_batches(lambda session, docs, sf_dir: seen.append(session.conf.get(key)))
    try:
        for value in (None, "1m"):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
            stage(spark, None, "")
        assert seen == [corpus_pipeline.BATCH_BYTES, "1m"]
    finally:
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)
