import re

import pytest
from llm_brute import base_spans
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from fundflow.llm import secret_scan as S
from fundflow.llm.common import table

DOCS = "doc_id long, text string"
HEX = "0123456789abcdef" * 2


def _spans(text):
    return sorted((m.start(), at, m.end(), r.kind) for at, r in enumerate(S.RULES)
                  for m in re.finditer(r.pattern, text) if len(m[r.group]) >= r.least)


def _redacted(text):
    out, at = [], 0
    for start, _, end, kind in _spans(text):
        if start >= at:
            out += [text[at:start], f"<secret:{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _scan(df):
    return df.select("doc_id", "text", "spans", S.spans_text(S.base_spans(F.col("spans"))).alias("base"),
                     S.spans_text(F.col("spans")).alias("all")).collect()


def test_trigram_queries():
    by = {r.kind: S.trigram_query(r.pattern) for r in S.RULES}
    assert by["hex"] == [] and by["access"] == [[frozenset({"aki", "kia"})]]
    assert frozenset({"tok", "oke", "ken"}) in by["assign"][0] and len(by["assign"][0]) == 6
    assert len(by["private_key"]) == 2
    assert S.trigram_query("ab") == [] and S.trigram_query("abc|xy") == []
    assert S.trigram_query("(?:abcd)+x*") == [[frozenset({"abc", "bcd"})]]


def test_queries_never_lose_a_match():
    texts = ["TOKEN = 'abcdef1'", "api_Key:zzzzzz", "AKIA" + "Q" * 16, "ghp_" + "a" * 36, "xoxb-1234567890",
             "-----BEGIN RSA PRIVATE KEY-----", "AIza" + "b" * 35, "eyJabcdefgh.abcdefgh.abcdefgh"]
    for rule in S.RULES:
        for t in texts:
            if re.search(rule.pattern, t):
                low = t.lower()
                assert all(any(all(g in low for g in o) for o in c) for c in S.trigram_query(rule.pattern))


def test_whole_table_against_regex(spark):
    rows = _scan(S.scan(table(spark, SF_ORACLE, "documents")))
    assert len(rows) == table(spark, SF_ORACLE, "documents").count()
    assert all(r.base == base_spans(r.text) for r in rows) and any(r.base for r in rows)


def test_edge_cases(spark):
    texts = [None, "", "token=token:abcdef", "é😀 secret: \"abc.def\" " + HEX, "password=ab secret=abcdefg",
             "AKIA" + "A1" * 8 + " AKIAshort AKIAAKIA" + "Z" * 16, "passwd = 'x' apikey==abcdef",
             ("word " * 20_000 + "token=\"" + HEX + "\" ") * 3, "key ghp_" + "aB" * 18]
    docs = spark.createDataFrame([(i, t, 7, "s") for i, t in enumerate(texts)] + [(4, "secret=zzzzzzz", 7, "s"),
                                 (None, "token:abcdefgh", 7, "s"), (2, texts[2], 7, "s")],
                                 DOCS + ", rules int, spans string")
    found = S.scan(docs)
    assert found.columns == ["doc_id", "text", "rules", "spans"]
    rows = _scan(found)
    assert len(rows) == docs.count()
    assert all(r.base == base_spans(r.text) for r in rows)
    assert [r.all for r in rows if r.doc_id == 8] == ["github:4:44"]
    assert S.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, f"é token=\"{HEX}\" end", 9, "a"), (2, "clean", 5, "b"), (3, None, None, "c")],
                                 DOCS + ", n_chars long, source string")
    out = S.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "é <secret:assign>\" end" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text) == ("clean", 5, None)


def test_private_keys_with_many_words(spark):
    rule = next(i for i, r in enumerate(S.RULES) if r.kind == "private_key")
    words = "WORD " * 100_000
    texts = ["-----BEGIN " + words + "PRIVATE KEY-----", "-----BEGIN " + words, "-----BEGIN PRIVATE KEY-----",
             "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN RSAPRIVATE KEY-----", "-----BEGIN  PRIVATE KEY-----",
             "-----BEGIN PRIVATE KEY PRIVATE KEY-----", "-----BEGIN PRIVATE PRIVATE KEY-----", "-----BEGIN KEY-----"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.order == rule] for r in S.scan(df).collect()}
    assert got == {i: [(0, len(t))] if i in (0, 2, 3, 6, 7) else [] for i, t in enumerate(texts)}
    assert [bool(re.search(S.RULES[rule].pattern, t)) for t in texts] == [bool(got[i]) for i in range(len(texts))]


@pytest.mark.parametrize("count", [255, 256, 257, 100_000])
def test_very_many_spans_in_one_text(spark, count):
    text = "é " + "".join(f"{i:x}".rjust(24, "a") + (" ß" if i % 3 else " token=short password=" + "q" * 7 + ".")
                          for i in range(count)) + "tail"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string").repartition(1)
    got = [(s.kind, s.start, s.end) for s in S.scan(docs).first().spans]
    assert got == [(k, a, b) for a, _, b, k in _spans(text)]
    assert S.redact(docs).first().text == _redacted(text)
