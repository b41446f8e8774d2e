"""What Python workers keep after an operator is done."""

import pandas as pd

import corpus_pipeline
from conftest import SF_SMALL
from fundflow.llm import bpe
from fundflow.llm.registry import tokenizer_path


def test_encoding_leaves_no_encoder_in_the_workers(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(64)], "doc_id long, text string").repartition(8)
    rows = bpe.encode(docs, tokenizer_path()).collect()
    assert all(r.token_ids for r in rows)

    def held(batches):                     # sent by value: workers don't import tests
        from fundflow.llm import bpe as own
        for pdf in batches:
            yield pd.DataFrame({"n": [len(own._ENCODERS)] * len(pdf)})

    left = spark.range(64).repartition(8).mapInPandas(held, "n long").collect()
    assert {r.n for r in left} == {0}


def test_pipeline_stages_send_texts_in_small_batches(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('words of text ', id) AS text", "'en' AS lang",
                                        "'web' AS source", "20L AS n_chars").coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        corpus_pipeline.token_ids(spark, docs, SF_SMALL)

        def sizes(batches):
            for pdf in batches:
                yield pd.DataFrame({"n": [len(pdf)]})

        assert max(r.n for r in docs.select("doc_id").mapInPandas(sizes, "n long").collect()) <= 500
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_language_stage_judges_each_text_once(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('words of text ', id) AS text",
                                      "if(id % 2 = 0, 'en', 'de') AS lang", "'web' AS source", "20L AS n_chars")
    plan = corpus_pipeline.identify_language(spark, docs, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
