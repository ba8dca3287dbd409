"""The corpus pipeline stage by stage."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline
from chatloom.llm import op7_packing, op10_pii
from chatloom.scratch import materialize

SF = "/root/testdata/sf0.01"


def test_stages_chain_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    counts = {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialize(stage(spark, before, SF), f"test-{name}")
        counts[name] = docs.count()
        if place < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "toxicity":
            clean = labels.where("toxic = 0").join(before, "doc_id").count()
            kept = labels.where("toxic = 0").join(docs, "doc_id").count()
            assert counts[name] < before.count() and kept >= 0.97 * clean
        if name == "near_copies":
            assert docs.select("text").distinct().count() == counts[name] < before.count()
        if name == "personal_data":
            assert counts[name] == before.count()
            marks = docs.where(F.col("text").rlike(r"@mail\d\.example\.com|\+1 \(\d{3}\) 555-")).count()
            original = before.where(F.col("text").rlike(r"@mail\d\.example\.com")).count()
            assert original > 0 and marks < 0.05 * original + 2
            old = {r.doc_id: r.text for r in before.collect()}
            plain = re.compile(r"[0-9@]")
            for row in docs.collect():
                if not plain.search(old[row.doc_id]):
                    assert row.text == old[row.doc_id]
        if name == "packing":
            ids = docs.select("doc_id").distinct()
            assert ids.join(before, "doc_id", "left_anti").count() == 0
            assert ids.count() == before.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF).columns == op7_packing._NAMES
    assert op10_pii.KEY
