"""The pipeline's stages in order, on the smallest tables and on an empty one."""

import corpus_pipeline
from tidemark.llm.common import stage, table

FOLDER = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = table(spark, FOLDER, "documents")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, FOLDER), name)
        assert docs.columns == columns
        if name == "near_duplicates":
            assert docs.count() < before and docs.select("doc_id").distinct().count() == docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.where("offset + length > 2048").count() == 0


def test_stages_take_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").where("1 = 0")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
        assert docs.count() == 0
