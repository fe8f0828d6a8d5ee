"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from eventide.llm.common import table
from eventide.llm.queries import QUERIES

from conftest import SF0001


def test_stages_and_run(spark):
    docs = table(spark, SF0001, "documents")
    columns, before = docs.columns, docs.count()
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "best_fit_packing"]
    kept = {r.doc_id for r in QUERIES["op4_quality_rules"](spark, SF0001).where("kept").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, SF0001).cache()
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
        if k == 0:
            assert {r.doc_id for r in docs.collect()} == kept
    last = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.run(spark, SF0001)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == last <= ids
