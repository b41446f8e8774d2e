"""Named tables and views: every report's SQL text equals its DataFrame form."""

import pytest

from conftest import SF_SMALL
from fundflow.plans import catalog, report_sql, reports
from fundflow.plans.pipeline import Models

NAME, INDUSTRY = "household", "Pharma & Healthcare"


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    m = Models.from_lens(spark, SF_SMALL)
    m.warehouse = str(tmp_path_factory.mktemp("published"))
    catalog.publish(m)
    yield m
    for layer in ("raw", *catalog.LAYERS):
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def _forms(m):
    s, f, t, c, p = m.score, m.funding, m.committee_tags, m.candidates, m.pair_sums
    return {
        "overview": reports.overview(s), "top_captured": reports.top_captured(s), "party_totals": reports.party_totals(s),
        "tier_by_office": reports.tier_by_office(s), "leaderboard": reports.leaderboard(s, "House", "%", "%"),
        "score_histogram": reports.score_histogram(s, "House", "%"), "industry_totals": reports.industry_totals(p, t, s),
        "industry_by_party": reports.industry_by_party(p, t, c),
        "top_recipients": reports.top_recipients(p, t, c, s, INDUSTRY), "dark_overview": reports.dark_overview(t, f, s),
        "dark_committees": reports.dark_committees(t, p), "dark_candidates": reports.dark_candidates(f, s),
        "profile": reports.profile(s, f, NAME), "funding_mix": reports.funding_mix(s, NAME),
        "industry_breakdown": reports.industry_breakdown(p, t, c, NAME),
        "component_breakdown": reports.component_breakdown(s, NAME), "top_senate": reports.top_by_office(s, "Senate")}


@pytest.mark.parametrize("name", sorted(report_sql.REPORTS))
def test_sql_text_equals_the_dataframe_form(spark, models, name):
    bound = {"office": "House", "party": "%", "year": "%", "name": f"%{NAME}%", "industry": INDUSTRY}
    text = report_sql.REPORTS[name]
    got = catalog.run_report(spark, text, **{k: v for k, v in bound.items() if f":{k}" in text})
    want = _forms(models)[name]
    assert set(got.columns) == set(want.columns)
    rows = [sorted(map(repr, (tuple(float(v) if hasattr(v, "as_tuple") else v for v in r)
                              for r in df.select(*sorted(df.columns)).collect()))) for df in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def test_raw_and_staging_tables_by_name(spark, models):
    assert spark.table("raw.pac_contributions").count() == models.raw["pac_contributions"].count()
    plan = spark.sql("SELECT sub_id FROM raw.pac_contributions WHERE cycle_year = 1996")
    assert "PartitionFilters: [isnotnull(cycle_year" in plan._jdf.queryExecution().executedPlan().toString()
    assert spark.table("staging.stg_pac_contributions").count() == models.pac.count()
    assert spark.catalog.tableExists("marts.mart_candidate_score_by_cycle")


def test_session_views_are_lazy_and_replaced(spark, models):
    names = catalog.register_views(models)
    assert {"stg_candidates", "mart_candidate_funding_summary", "raw_committees"} <= set(names)
    assert spark.sql("SELECT count(*) AS n FROM mart_candidate_corruption_score").first().n == models.score.count()
    catalog.register_views(models)
    for name in names:
        spark.catalog.dropTempView(name)


def test_publishing_again_replaces_and_bad_names_fail(spark, models):
    assert catalog.publish(models) == catalog.publish(models)
    with pytest.raises(ValueError):
        catalog.publish(models, {"marts": "a; drop"})
    with pytest.raises(ValueError):
        catalog.publish(Models.from_lens(spark, SF_SMALL))
