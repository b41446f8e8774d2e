"""Scalar functions on hand-made edge rows."""

import datetime as dt

from pyspark.sql import functions as F

from fundflow.functions import decode as D
from fundflow.functions.text import (candidate_display_name, candidate_first_name,
                                     candidate_last_name, normalize_employer, title_case)


def _one(spark, expr, values, type_="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {type_}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_display_names(spark):
    got = _one(spark, candidate_display_name,
               ["SANDERS, BERNARD", "BERNIE SANDERS", "SMITH, JOHN, JR", "SMITH,", None])
    assert got == ["Bernard Sanders", "Bernie Sanders", "John Smith", None, None]


def test_first_last(spark):
    assert _one(spark, candidate_last_name, ["SANDERS, BERNARD", "BERNIE SANDERS"]) == \
        ["Sanders", "Bernie Sanders"]
    assert _one(spark, candidate_first_name, ["SANDERS, BERNARD", "BERNIE SANDERS"]) == \
        ["Bernard", None]


def test_title_case(spark):
    got = _one(spark, title_case, ["  new   YORK  ", "", "   ", None, "smith-JONES", "o'BRIEN"])
    assert got == ["New York", None, None, None, "Smith-jones", "O'brien"]


def test_employer(spark):
    got = _one(spark, normalize_employer,
               ["JOHNSON & JOHNSON", "AT&T INC", "FOO CO INC", "  acme   corp. ", "", None,
                "GOLDMAN SACHS LLC"])
    assert got == ["Johnson And Johnson", "At And t", "Foo Co", "Acme", "", None, "Goldman Sachs"]


def test_size_buckets(spark):
    amounts = ["199.99", "200", "999", "999.50", "1000", "2999", "2999.50", "3000", "-5"]
    df = spark.createDataFrame([(a,) for a in amounts], "a string").select(
        F.col("a").cast("decimal(12,2)").alias("amount"))
    df = df.select(D.size_bucket(D.is_refund(F.lit("15"), "amount"), "amount").alias("b"))
    assert [r.b for r in df.collect()] == ["small", "medium", "medium", None, "large", "large",
                                           None, "major", "refund"]


def test_refund_three_valued(spark):
    df = spark.createDataFrame([(None, "50"), ("22Y", "50"), (None, "-1"), ("15", "5")],
                               "t string, a string")
    got = [r[0] for r in df.select(D.is_refund("t", F.col("a").cast("decimal(12,2)"))).collect()]
    assert got == [None, True, True, False]


def test_dates(spark):
    assert _one(spark, D.filing_date, ["01312024", "1312024", None]) == \
        [dt.date(2024, 1, 31), None, None]
    got = _one(spark, D.report_end_timestamp, ["12/31/2024", "2/3/2024", "", "02/30/2024"])
    assert got == [dt.datetime(2024, 12, 31), dt.datetime(2024, 2, 3), None, None]


def test_decode_defaults(spark):
    got = _one(spark, lambda c: D.decode(c, D.PARTY, D.PARTY_DEFAULT), ["DEM", "XXX", None])
    assert got == ["Democrat", "Other / Unknown", "Other / Unknown"]
    got = _one(spark, lambda c: D.decode(c, D.OFFICE), ["H", "Z", None])
    assert got == ["House", "Z", None]


def test_median_of_integers_matches_percentile(spark):
    import random
    from fundflow.operators.median import median_of_integers
    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 20)}", rnd.choice([None, rnd.randint(0, 500)]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r.m for r in median_of_integers(df, "k", "v", "m").collect()}
    exp = {r.k: int(r.p // 1) for r in df.groupBy("k").agg(F.percentile("v", 0.5).alias("p"))
           .collect() if r.p is not None}
    assert got == exp


def test_lenient_dates(spark):
    assert _one(spark, lambda c: D.filing_date(c, lenient=True), ["13312024", "01312024"]) == \
        [None, dt.date(2024, 1, 31)]


def test_employer_stop_list_casefold(spark):
    from fundflow.plans.tagging import employer_eligible
    df = spark.createDataFrame([("Retired",), ("",), ("Acme",), (None,)], "donor_employer string")
    plain = [r[0] for r in df.select(employer_eligible()).collect()]
    folded = [r[0] for r in df.select(employer_eligible(casefold=True)).collect()]
    assert plain == [True, False, True, False]
    assert folded == [False, False, True, False]


def test_committees_latest_per_id(spark):
    from fundflow.plans.staging import stg_committees
    from fundflow.sources.layouts import CM_COLUMNS
    rows = []
    for year, name in [(2020, "OLD NAME PAC"), (2024, "NEW NAME PAC")]:
        r = {c: None for c in CM_COLUMNS}
        r.update(cmte_id="C1", cmte_nm=name, cmte_tp="O")
        rows.append(tuple(r[c] for c in CM_COLUMNS) + (year, "cm.txt"))
    schema = ", ".join(f"{c} string" for c in CM_COLUMNS) + ", cycle_year int, source_file string"
    raw = spark.createDataFrame(rows, schema)
    assert stg_committees(raw).count() == 2
    latest = stg_committees(raw, latest_per_id=True).collect()
    assert [r.committee_name for r in latest] == ["New Name Pac"]
