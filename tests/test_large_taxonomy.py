"""Keyword matching beyond the inline taxonomy: exact, and about one row a letter of text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from fundflow.operators import keyword_match as S
from fundflow.plans import tagging
from fundflow.sources import seeds

TAX = "keyword string, industry string, industry_group string, priority int"


def _keywords(count, seed=1):
    rng = random.Random(seed)
    letters = "abcdeimnorst "
    out = {"".join(rng.choices(letters, k=rng.randrange(3, 14))).strip() for _ in range(2 * count)}
    return [(k, k.upper(), "G", rng.choice([None, 1, 2, 3])) for k in sorted(x for x in out if len(x) > 2)[:count]]


def _best(texts, keywords, whole):
    order = sorted(keywords, key=lambda r: (r[3] is None, r[3] or 0, r[0]))
    def found(k, t):
        if not whole or k.lower() not in t:
            return k.lower() in t
        return re.search(r"(?<![^\W_])" + re.escape(k.lower()) + r"(?![^\W_])", t)
    return {t: next((k[0] for k in order if found(k[0], t.lower())), None) for t in texts}


@pytest.mark.parametrize("whole", [False, True])
def test_fifty_thousand_keywords(spark, whole):
    keywords = _keywords(50_000)
    assert len(keywords) == 50_000
    rng = random.Random(7)
    texts = ["".join(rng.choices("ABCDEIMNORST xyz", k=rng.randrange(0, 40))) for _ in range(60)] + ["", "Q9", "zz"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.m and r.m.keyword for r in S.first_match_join(
        df, ["t"], spark.createDataFrame(keywords, TAX), "m", whole_words=whole).collect()}
    assert got == _best(set(texts), keywords, whole)


def test_rows_emitted_are_near_the_text_length(spark):
    tax = spark.createDataFrame(_keywords(2_000), TAX).select(F.lower("keyword").alias("_kw"))
    filed = S.filed_keywords(tax)
    sizes = [r[0] for r in filed.select(F.length("_gram")).distinct().collect()]
    assert sizes == [S.GRAM] and filed.count() == tax.distinct().count()
    texts = spark.createDataFrame([("x" * 500,), ("ab",), ("",)], "_text string")
    assert S.text_grams(texts, sizes).count() == 498


def test_short_and_special_keywords(spark):
    keywords = [(k, "I", "G", i) for i, k in enumerate(["a\\Eb", "c.d", "é", "ab", "(x", ""])]
    texts = ["xa\\ebx", "cxd", "c.d", "É!", "tab", "f(x)", "none of these"]
    df, tax = spark.createDataFrame([(t,) for t in texts], "t string"), spark.createDataFrame(keywords, TAX)
    for whole in (False, True):
        joined = {r.t: r.m.keyword for r in S.first_match_join(df, ["t"], tax, "m", whole_words=whole).collect()}
        inline = {r.t: r.m.keyword for r in S.add_first_match(df, ["t"], tax, "m", whole_words=whole).collect()}
        assert joined == inline
    assert joined["tab"] == "" and joined["c.d"] == "c.d"


def test_whole_words_of_committee_names(spark):
    tax = spark.createDataFrame([("gas", "Energy", "E", 1)], TAX)
    rows = spark.createDataFrame([("C1", "Las Vegas Pac", None), ("C2", "Natural Gas Pac", None)],
                                 "committee_id string, committee_name string, connected_organization_name string")
    ids = lambda **more: {r.committee_id for r in tagging.keyword_matches(rows, tax, **more).collect()}
    assert ids() == {"C1", "C2"} and ids(whole_words=True) == {"C2"}


def test_a_seed_that_does_not_fit_fails(spark, scratch):
    with open(f"{scratch}/tax.csv", "w") as fh:
        fh.write("keyword,industry,industry_group,priority\noil,Energy,E,first\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        seeds.read_seed_csv(spark, f"{scratch}/tax.csv", seeds.TAXONOMY_SCHEMA).collect()
