"""The pipeline's stages against their definitions, each on its own input."""

from __future__ import annotations

import corpus_pipeline
from gridmetrics.llm import toxicity, wu_manber
from gridmetrics.llm.common import remainder

SF = "/root/testdata/sf0.001"


def test_each_stage_on_its_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.learned(docs, labels, remainder("doc_id", 4) != 2)
    toxic = {r.doc_id for r in toxicity.score(docs, model).where("score >= 0.3").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in kept.collect()}
        after = stage(spark, kept, SF)
        ids = {r.doc_id for r in after.collect()}
        if name != "encoding":
            assert after.columns == docs.columns
        if name == "toxicity":
            assert ids == before.keys() - toxic
        if name == "near_dedup":
            assert ids <= before.keys()
            texts = [before[i].text for i in ids]
            assert len(set(texts)) == len(texts) and {before[i].text for i in before} >= set(texts)
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            bad = wu_manber.decontaminate(kept, bench).where("contaminated").collect()
            assert ids == before.keys() - {r.doc_id for r in bad}
        if name in ("pii", "encoding"):
            assert ids == before.keys()
        kept = spark.createDataFrame(after.collect(), after.schema)
    result = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in result.collect()) == sorted(r.doc_id for r in kept.collect())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        assert after.count() == 0
