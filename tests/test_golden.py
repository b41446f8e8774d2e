"""Rows with literal expected values, apart from the constants that code and oracle share."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from fundflow.functions import decode, text
from fundflow.plans import marts, quality, reports, tagging
from fundflow.plans.pipeline import Models
from fundflow.sources import seeds


def _one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn("v")).first()[0]


@pytest.mark.parametrize("name, shown", [
    ("SANDERS, BERNARD", "Bernard Sanders"), ("BERNIE SANDERS", "Bernie Sanders"),
    ("SMITH, JOHN, JR", "John Smith"), ("SMITH,", None), ("  ", None)])
def test_display_names(spark, name, shown):
    assert _one(spark, name, text.candidate_display_name) == shown


@pytest.mark.parametrize("raw, shown", [
    ("JOHNSON & JOHNSON", "Johnson And Johnson"), ("AT&T INC", "At And t"), ("FOO CO INC", "Foo Co"), ("", "")])
def test_employers(spark, raw, shown):
    assert _one(spark, raw, text.normalize_employer) == shown


def test_size_buckets_and_refunds(spark):
    rows = [("199.99", "small"), ("200", "medium"), ("999", "medium"), ("999.50", None), ("1000", "large"),
            ("2999", "large"), ("2999.50", None), ("3000", "major"), ("-5", "refund")]
    df = spark.createDataFrame([(i, Decimal(a)) for i, (a, _) in enumerate(rows)], "i int, amount decimal(12,2)")
    out = df.withColumn("is_refund", decode.is_refund(F.lit("15"), F.col("amount")))
    got = out.select("i", decode.size_bucket("is_refund", "amount").alias("b")).orderBy("i").collect()
    assert [r.b for r in got] == [b for _, b in rows]
    unknown = spark.createDataFrame([(Decimal(50),)], "amount decimal(12,2)").select(
        decode.is_refund(F.lit(None).cast("string"), F.col("amount")))
    assert unknown.first()[0] is None


def test_dates(spark):
    assert _one(spark, "01312024", decode.filing_date) == date(2024, 1, 31)
    assert _one(spark, "1312024", decode.filing_date) is None
    assert _one(spark, "13312024", lambda c: decode.filing_date(c, lenient=True)) is None
    for bad in ("", "02/30/2024", None):
        assert _one(spark, bad, decode.report_end_timestamp) is None
    assert _one(spark, "2/3/2024", decode.report_end_timestamp).date() == date(2024, 2, 3)


def test_code_tables(spark):
    shown = {"DEM": "Democrat", "REP": "Republican"}
    for code, name in shown.items():
        assert _one(spark, code, lambda c: decode.decode(c, decode.PARTY)) == name
    for code, name in {"H": "House", "S": "Senate", "P": "President"}.items():
        assert _one(spark, code, lambda c: decode.decode(c, decode.OFFICE)) == name
    assert decode.SUPER_PAC_TYPE == "O"


def _funding(spark, **values):
    base = dict.fromkeys((c for c, _ in marts.INDUSTRY_COLUMNS), 0.0) | {
        "total_raised": 1000.0, "pct_from_pacs": 0.0, "pct_from_individuals": 0.0, "pct_dark_money": 0.0,
        "pct_super_pac": 0.0, "pct_individual_from_large": None, "median_individual_donation": None,
        "large_donor_total": 0.0} | values
    row = {"candidate_id": "H1", "candidate_name": "A", "party_name": "Democrat", "office": "House",
           "office_state": "X", "election_year": 2024, "incumbent_challenger_status": "I",
           "unique_donor_count": 1} | base
    schema = T.StructType([T.StructField(k, T.DoubleType() if isinstance(v, float) or v is None
                                         else T.LongType() if isinstance(v, int) else T.StringType())
                           for k, v in row.items()])
    return spark.createDataFrame([tuple(row.values())], schema)


@pytest.mark.parametrize("pacs, score, tier", [
    (0.0, 0.0, "Lower Risk"), (21.4, 15.0, "Moderate Risk"), (21.2, 14.8, "Lower Risk"),
    (64.3, 45.0, "High Risk"), (64.0, 44.8, "Moderate Risk"), (100.0, 70.0, "High Risk")])
def test_score_and_tier_bounds(spark, pacs, score, tier):
    """PAC share alone: 0.70 a point, at most 70; tiers from 15 and 45."""
    r = marts.score_components(_funding(spark, pct_from_pacs=pacs)).first()
    assert (r.corruption_score, r.risk_tier) == (score, tier)


def test_taxonomy_seed(spark, scratch):
    rows = seeds.taxonomy_rows()
    assert len(rows) == 93
    by = {r[0]: r for r in rows}
    assert by["at and t"][2] == "Tech & Telecom" and by["oil"][3] == 1 and by["energy"][3] == 2
    path = f"{scratch}/taxonomy"
    seeds.industry_taxonomy(spark).write.option("header", True).csv(path)
    back = seeds.read_seed_csv(spark, path, seeds.TAXONOMY_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    cats = f"{scratch}/categories"
    seeds.lens_categories(spark).write.option("header", True).csv(cats)
    m = Models(spark, Models.from_lens(spark, SF_SMALL).sources, back,
               seeds.read_seed_csv(spark, cats, seeds.CATEGORY_SCHEMA))
    assert m.committee_tags.filter("match_source = 'opensecrets'").count() > 0


def test_keyword_priority(spark):
    df = spark.createDataFrame([("c1", "Pfizer Fund", None), ("c2", "Energy Oil", None),
                                ("c3", "Las Vegas Sands", None)],
                               "committee_id string, committee_name string, connected_organization_name string")
    got = {r.committee_id: r.industry_group for r in
           tagging.keyword_matches(df, seeds.industry_taxonomy(spark)).collect()}
    assert got == {"c1": "Pharma & Healthcare", "c2": "Energy & Oil", "c3": "Energy & Oil"}


def test_options_reach_the_models(spark):
    plain, strict = Models.from_lens(spark, SF_SMALL), Models.from_lens(
        spark, SF_SMALL, dedupe_links=True, whole_words=True, casefold_stop_list=True, latest_committee=True,
        lenient_dates=True)
    retired = F.col("donor_employer") == "Retired"
    assert plain.donor_industry.filter(retired).count() > 0
    assert strict.donor_industry.filter(retired).count() == 0
    assert strict.flow.count() < plain.flow.count()
    ids = strict.committees.select("committee_id")
    assert ids.count() == ids.distinct().count() < plain.committees.count()


def test_uniqueness_scope_and_unclassified_money(spark):
    m = Models.from_lens(spark, SF_SMALL)
    failing = lambda per_cycle: {
        (r.check_name, r.table_name): r.failing_rows
        for r in quality.quality_report(m.raw, per_cycle).collect() if r.check_name == "unique"}
    scoped, strict = failing(True), failing(False)
    assert strict["unique", "committees"] > scoped["unique", "committees"] == 0
    groups = lambda **o: {r.industry_group for r in reports.industry_totals(
        m.flow, m.committee_tags, m.score, **o).collect()}
    assert "Unknown" in groups() and "Unknown" not in groups(exclude_group="Unknown")


def test_reports_are_sorted(spark):
    m = Models.from_lens(spark, SF_SMALL)
    party = [r.total_raised for r in reports.party_totals(m.score).collect()]
    assert party == sorted(party, reverse=True)
    tiers = [(r.office, -r.candidates, r.risk_tier) for r in reports.tier_by_office(m.score).collect()]
    assert tiers == sorted(tiers)
    for df, column in ((reports.industry_totals(m.flow, m.committee_tags, m.score), "total_contributed"),
                       (reports.industry_by_party(m.flow, m.committee_tags, m.candidates), "total"),
                       (reports.industry_breakdown(m.flow, m.committee_tags, m.candidates, "household"), "total")):
        values = [r[column] for r in df.collect()]
        assert values and values == sorted(values, reverse=True)


def test_failed_build_is_repeated(spark, scratch, monkeypatch):
    m = Models.from_lens(spark, SF_SMALL)
    m.warehouse = f"{scratch}/wh"
    with monkeypatch.context() as patch:
        patch.setattr(marts, "candidate_capture_score", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            m.score
    assert m.score.count() > 0
    again = Models.from_lens(spark, SF_SMALL)
    again.warehouse = m.warehouse              # complete: read, not built
    with monkeypatch.context() as patch:
        patch.setattr(marts, "candidate_capture_score", lambda *_: 1 / 0)
        assert again.score.count() == m.score.count()
