import re

import pytest
from llm_brute import base_spans, components, simhash
from oracle_compare import compare, duck
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from fundflow.llm import bpe, decontaminate, language_id, registry
from fundflow.llm.common import table

CONTRACT = {
    "op1_": "doc_id held_out lang_pred score",
    "op2_": "doc_id size text_crc32 law shard slot grown_shard",
    "op3_": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4_": "page_id payload_bytes payload_digest record_type refers_to",
    "op5_": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op6_": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_": "doc_id item_id",
    "op8_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op9_": "doc_id fingerprint component_id",
    "op10_": "page_id url text n_chars",
    "op11_": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op13_": "lang rank phrase a l r n score",
}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, name):
    problems, _, _ = compare(registry.queries()[name](spark, SF_SMALL), duck(SF_SMALL), registry.oracle_sql()[name])
    assert not problems, problems


@pytest.mark.parametrize("prefix", sorted(CONTRACT))
def test_columns_of_the_contract(spark, prefix):
    (name,) = [n for n in registry.queries() if n.startswith(prefix)]
    assert set(CONTRACT[prefix].split()) <= set(registry.queries()[name](spark, SF_SMALL).columns)


def test_pipeline_against_brute_force(spark):
    docs = {r.doc_id: r for r in table(spark, SF_ORACLE, "documents").collect()}
    items = [r.text for r in table(spark, SF_ORACLE, "benchmark").collect()]
    kept = {i: r for i, r in docs.items() if re.search(r"[^\W\d_]", r.text or "")}
    group = components({i: simhash(r.text) for i, r in kept.items()})
    kept = {i: r for i, r in kept.items() if group[i] == i}
    split = lambda t: re.findall(r"\w+", t.lower())
    n = decontaminate.WINDOW
    grams = {tuple(w[i:i + n]) for t in items for w in [split(t)] for i in range(len(w) - n + 1)}
    kept = {i: r for i, r in kept.items()
            if not any(tuple(w[k:k + n]) in grams for w in [split(r.text)] for k in range(len(w) - n + 1))}
    encoder = bpe.Encoder(bpe.load_vocabulary(registry.tokenizer_path()))
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_ORACLE).collect()}
    assert set(rows) == set(kept)
    changed = 0
    for i, r in rows.items():
        assert (r.lang, r.source) == (kept[i].lang, kept[i].source)
        if base_spans(kept[i].text):
            changed += 1
            assert r.n_chars != kept[i].n_chars
        else:
            (count, ids, _), = encoder.encode([kept[i].text])
            assert (r.n_tokens, " ".join(map(str, r.token_ids)), r.n_chars) == (count, ids, kept[i].n_chars)
    assert changed and len(rows) < len(docs)


def test_stages_keep_the_columns_and_empty_tables(spark):
    docs = table(spark, SF_SMALL, "documents").filter("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0


@pytest.mark.parametrize("families", [2, 3])
def test_language_stage_rejects_foreign_and_junk_texts_and_keeps_clean_ones(spark, families):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    if families == 3:                         # a third family: the Spanish texts in another script
        docs = docs.withColumn("text", F.when(F.col("lang") == "es", F.translate(
            F.lower("text"), "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ")).otherwise(F.col("text"))) \
            .withColumn("lang", F.when(F.col("lang") == "es", "ru").otherwise(F.col("lang")))
    planted = ["Tämä on suomenkielinen teksti joka ei kuulu tähän joukkoon lainkaan. ",
               "Αυτό το κείμενο είναι γραμμένο στα ελληνικά και δεν ανήκει εδώ. ",
               "xqzvw kjhgf qwrtp zxcvb mnbvq wqxzk jvkqx pzqgw vbkxq "]
    model = language_id.train(docs)
    more = spark.createDataFrame([(-1 - i, t * 3, "en", "s", len(t)) for i, t in enumerate(planted)]
                                 + [(-9, "12 34", "en", "s", 5)], docs.schema)
    kept = {r.doc_id: r.lang_pred for r in language_id.learned(docs.unionByName(more), model).collect()}
    clean = {r.doc_id: r.lang for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")}
    assert set(kept) == set(clean)
    assert sum(kept[i] != clean[i] for i in clean) < 10
