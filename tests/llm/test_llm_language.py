from pyspark.sql import functions as F

from conftest import SF_ORACLE
from fundflow.llm import language_id as L
from fundflow.llm.common import table

DOCS = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text", "lang")
    out = L.held_out(F.col("doc_id"))
    model = L.train(docs.filter(~out))
    assert model["families"] == ["germanic", "romance"] and len(model["pairs"]) == 2
    rows = L.predict(docs.withColumn("held", out), model).collect()
    held = [r for r in rows if r.held]
    assert len(rows) == docs.count() and 0.25 < len(held) / len(rows) < 0.42
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    # the label and the id of a row to be predicted play no part
    blind = L.predict(docs.select((F.col("doc_id") * 7).alias("doc_id"), "text", F.lit("xx").alias("lang")), model)
    assert {(r.doc_id // 7, r.lang_pred, r.score) for r in blind.collect()} == {
        (r.doc_id, r.lang_pred, r.score) for r in rows}


def test_training_ignores_held_out_and_unlabelled_rows(spark):
    rows = [(i, t, g) for i in range(60) for t, g in [("the and of with this that", "en"), ("der die und nicht das", "de")]]
    odd = [(1000, "the the the", None), (None, "the the", "de"), (1001, None, "fr")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    a, b = L.train(docs), L.train(spark.createDataFrame(rows, DOCS))
    assert a["members"] == b["members"] == [["de", "en"]] and (a["weights"] == b["weights"]).all()


def test_edge_cases(spark):
    train = spark.createDataFrame([(i, t, g) for i in range(30) for t, g in [
        ("the and of with this that", "en"), ("le la les dans une avec", "fr"), ("kissa koira talo on", "fi"),
        ("los las una con para", "es"), ("unknown tongue zq zx", "xx")]], DOCS)
    model = L.train(train)
    assert model["families"] == ["germanic", "romance", "uralic", "xx"]
    texts = [None, "", "123 !?", "the and with", "LES DANS AVEC", "kissa talo", "x", "los una para " * 50_000, "字"]
    docs = spark.createDataFrame([(i, t, "q", 2) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang_pred string, extra int")
    found = L.predict(docs, model)
    assert found.columns == ["doc_id", "text", "extra", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert [got[i] for i in range(3)] == [("und", 0.0)] * 3
    assert [got[i][0] for i in (3, 4, 5, 7)] == ["en", "fr", "fi", "es"]
    assert got[6][0] != "und" and got[8][0] != "und"
    empty = spark.createDataFrame([], DOCS)
    assert L.predict(empty, model).count() == 0
    nothing = L.predict(docs, L.train(empty)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    single = L.predict(docs, L.train(train.filter("lang = 'fr'"))).filter("doc_id = 3").first()
    assert single.lang_pred == "fr" and single.score == 1.0


def test_sample_bound(spark):
    docs = spark.createDataFrame([(i, f"word{i} the", "en") for i in range(200)], DOCS)
    assert L.train(docs, sample=5)["members"] == [["en"]]
