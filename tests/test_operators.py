"""Operators against brute force and Spark's own window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fundflow.operators.dedup import best_per_key
from fundflow.operators.keyword_match import (add_first_match, first_match_join,
                                              sort_keywords)
from fundflow.operators.ranking import ntile_distributed, percent_rank_by_histogram
from fundflow.sources import seeds


def _texts(n, seed=7):
    rnd = random.Random(seed)
    words = ["las vegas sands", "boilermakers", "pfizer", "energy", "oil", "gas", "meta",
             "metal", "union", "at and t", "red", "ring", "widget", "plain", "co", "", "nra"]
    out = []
    for _ in range(n):
        k = rnd.randint(0, 4)
        out.append(" ".join(rnd.choice(words) for _ in range(k)).upper() or None)
    return out


def _brute(text, kws):
    if text is None:
        return None
    hits = [(p is None, p or 0, k) for k, _, _, p in kws if k.lower() in text.lower()]
    return min(hits)[2] if hits else None


def test_keyword_inline_and_join_match_brute_force(spark):
    rows = seeds.taxonomy_rows() + seeds.LENS_KEYWORDS
    kws = sort_keywords(rows)
    tax = seeds.lens_taxonomy(spark)
    texts = _texts(400)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    inline = {r.id: (r.m.keyword if r.m else None)
              for r in add_first_match(df, ["t"], tax, "m").collect()}
    joined = {r.id: (r.m.keyword if r.m else None)
              for r in first_match_join(df, ["t"], tax, "m").collect()}
    for i, t in enumerate(texts):
        assert inline[i] == _brute(t, kws), t
        assert joined[i] == inline[i], t


def test_best_per_key_picks_first_in_order(spark):
    df = spark.createDataFrame([("a", 2020, "x"), ("a", 2024, "y"), ("b", None, "z"),
                                ("b", 1998, "w")], "k string, y int, v string")
    got = {r.k: r.v for r in best_per_key(df, ["k"], [F.col("y").desc_nulls_last()]).collect()}
    assert got == {"a": "y", "b": "w"}


def _skewed(spark, n=3000):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        # a third of all rows share one partition key and many share a score
        part = "hot" if i % 3 == 0 else f"p{rnd.randint(0, 5)}"
        year = None if i % 7 == 0 else 2000 + 2 * rnd.randint(0, 2)
        rows.append((f"id{i:05d}", part, year, float(round(rnd.choice([0, 100, rnd.random() * 100]), 1))))
    return spark.createDataFrame(rows, "id string, office string, year int, score double")


def test_ntile_and_percent_rank_equal_windows(spark):
    df = _skewed(spark)
    part = ["year", "office"]
    w = Window.partitionBy(*part).orderBy("score", "id")
    expected = {r.id: (r.d, r.p) for r in df.select(
        "id", F.ntile(10).over(w).alias("d"),
        F.percent_rank().over(Window.partitionBy(*part).orderBy("score")).alias("p")).collect()}
    got = ntile_distributed(df, part, ["score"], "id", 10, "d")
    got = percent_rank_by_histogram(got, part, "score", "p")
    got = {r.id: (r.d, r.p) for r in got.collect()}
    assert got == expected


def test_global_percent_rank(spark):
    df = _skewed(spark, 1500)
    expected = {r.id: r.p for r in df.select(
        "id", F.percent_rank().over(Window.orderBy("score")).alias("p")).collect()}
    got = {r.id: r.p for r in percent_rank_by_histogram(df, [], "score", "p").collect()}
    assert got == expected


def test_whole_word_keywords(spark):
    from fundflow.operators.keyword_match import first_match_inline
    kws = sort_keywords(seeds.taxonomy_rows())
    df = spark.createDataFrame([("Las Vegas Sands",), ("Boilermakers Union",), ("Shell Oil",),
                                ("Metal Works",)], "t string")
    got = [r[0] for r in df.select(first_match_inline([F.col("t")], kws, whole_words=True)
                                   .keyword).collect()]
    assert got == ["las vegas sands", "union", "oil", None]


def test_dedupe_links(spark):
    from fundflow.plans.flows import individual_via_committee
    from fundflow.plans.pipeline import Models
    from conftest import SF_SMALL
    m = Models.from_lens(spark, SF_SMALL)
    n_all = individual_via_committee(m.individual, m.linkage, m.taxonomy, keywords=m.keywords).count()
    n_one = individual_via_committee(m.individual, m.linkage, m.taxonomy, keywords=m.keywords,
                                     dedupe_links=True).count()
    assert n_one < n_all


def test_keyword_property_random_texts(spark):
    """Texts glued from keyword pieces (overlaps, in-word hits, case): all plans agree."""
    from hypothesis import given, settings, strategies as st
    kws = sort_keywords(seeds.taxonomy_rows() + seeds.LENS_KEYWORDS)
    pieces = [k for k, _, _, _ in kws] + ["x", " ", "-", "&", "Co", "AT&T", "Vegas", "boil"]
    tax = seeds.lens_taxonomy(spark)
    batch = []

    @settings(max_examples=150, deadline=None, derandomize=True)
    @given(st.lists(st.sampled_from(pieces), min_size=0, max_size=6),
           st.sampled_from([str.upper, str.lower, str.title]))
    def collect(parts, case):
        batch.append(case("".join(parts)))

    collect()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "id int, t string")
    inline = {r.id: (r.m.keyword if r.m else None)
              for r in add_first_match(df, ["t"], tax, "m").collect()}
    joined = {r.id: (r.m.keyword if r.m else None)
              for r in first_match_join(df, ["t"], tax, "m").collect()}
    for i, t in enumerate(batch):
        assert inline[i] == _brute(t, kws) == joined[i], t


TAXONOMY = "keyword string, industry string, industry_group string, priority int"


def _both_plans(spark, rows, texts, **options):
    tax = spark.createDataFrame(rows, TAXONOMY)
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "id int, a string, b string")
    found = []
    for most in (10_000, 0):                   # 0: the join plan
        out = add_first_match(df, ["a", "b"], tax, "m", max_inline=most, **options)
        found.append({r.id: tuple(r.m) if r.m else None for r in out.collect()})
    return found


def test_both_plans_share_one_semantics(spark):
    texts = [("Alpha Beta", None), ("beta", "alpha"), ("GAMMA", ""), (None, None), ("", ""), ("xalphax", "b"),
             ("gamma-ray", "beta2")]
    rows = [("alpha", "A", "ga", None), ("Beta", "B", "gb", None), ("gamma", "G", "gg", 5), (None, "N", "gn", 1),
            ("BETA", "B2", "gb2", 7), ("beta2", None, None, 9)]
    inline, joined = _both_plans(spark, rows, texts)
    assert inline == joined
    assert inline[0][0] == "BETA" and inline[2][0] == "gamma" and inline[3] is None and inline[4] is None
    whole_inline, whole_joined = _both_plans(spark, rows, texts, whole_words=True)
    assert whole_inline == whole_joined and whole_inline[5] is None and whole_inline[6][0] == "gamma"
    # the empty keyword is contained in every text that there is
    inline, joined = _both_plans(spark, rows + [("", "E", "ge", 8)], texts)
    assert inline == joined and inline[4][0] == "" and inline[3] is None and inline[5][0] == ""
    # only NULL priorities: by keyword
    inline, joined = _both_plans(spark, rows[:2], texts[:2])
    assert inline == joined and inline[0][0] == inline[1][0] == "Beta"


def test_large_taxonomy_like_the_small_one(spark):
    rows = [(f"k{i}", f"i{i}", "g", i % 7 if i % 5 else None) for i in range(700)]
    texts = [(f"x k{i * 3} k{i} y", f"k{i + 100}z") for i in range(150)]
    for whole in (False, True):
        inline, joined = _both_plans(spark, rows, texts, whole_words=whole)
        assert inline == joined
        default = add_first_match(spark.createDataFrame([(1, "a k699 b")], "id int, t string"), ["t"],
                                  spark.createDataFrame(rows, TAXONOMY), "m", whole_words=whole).first()
        assert default.m.keyword in ("k699", "k69", "k6")
