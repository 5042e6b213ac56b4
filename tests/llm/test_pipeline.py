"""The corpus pipeline: every stage's decisions on planted documents."""

from __future__ import annotations

import os

import pytest

pytest.importorskip("cadastra.llm")
pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")
def test_stages_keep_columns_and_drop_planted_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    base = docs.where("length(text) > 600").limit(20)
    copies = base.selectExpr("doc_id + 1000000 as doc_id", "concat(text, ' end') as text", "lang", "source", "n_chars")
    kept = {r.doc_id for r in stages["MinHash near-dedup"](spark, base.unionByName(copies), SF).collect()}
    assert kept and max(kept) < 1_000_000
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null").first().text
    leak = spark.createDataFrame([(7, "before " + item + " after", "en", "web", 1), (8, "a clean line of words", "en", "web", 1)], docs.schema)
    left = stages["benchmark decontamination"](spark, leak, SF)
    assert [r.doc_id for r in left.collect()] == [8] and left.columns == docs.columns
