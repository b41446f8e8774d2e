"""Model tables, published names and loads cost what their reader needs, and no more."""

import os

from conftest import SF_SMALL
from fundflow import queries
from fundflow.plans import catalog, flows, report_sql
from fundflow.plans.pipeline import Models
from fundflow.sources import loader

LINK = "candidate_committee_linkage"


def _models(spark, folder):
    m = Models.from_lens(spark, SF_SMALL)
    m.warehouse = folder
    return m


def _tables(folder):
    return {n for n in os.listdir(folder) if not n.endswith("-complete")}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_model_builds_only_the_tables_it_reads(spark, scratch):
    funding = _models(spark, f"{scratch}/a")
    plain = Models.from_lens(spark, SF_SMALL)
    assert sorted(map(repr, funding.funding.collect())) == sorted(map(repr, plain.funding.collect()))
    assert _tables(funding.warehouse) == {"committee_tags", "tagged_donations", "flow_by_cycle", "funding_extras"}
    assert funding.score.count() == plain.score.count()
    assert _tables(funding.warehouse) >= {"score"} and "raw" not in _tables(funding.warehouse)


def test_a_staging_model_writes_only_its_raw_table(spark, scratch):
    m = _models(spark, f"{scratch}/a")
    assert m.committees.count() > 0
    assert os.listdir(f"{m.warehouse}/raw") == ["committees"]
    assert set(m.raw) == set(m.sources) == set(os.listdir(f"{m.warehouse}/raw"))


def test_only_the_names_of_a_report_are_published_and_tables_are_not_copied(spark, scratch):
    m = _models(spark, f"{scratch}/a")
    schemas = {layer: f"few_{layer}" for layer in ("raw", *catalog.LAYERS)}
    names = catalog.named_in(report_sql.REPORTS["industry_totals"])
    assert names == {"intermediate.int_contributions_to_candidates", "intermediate.int_committee_industry_tags",
                     "marts.mart_candidate_corruption_score"}
    placed = catalog.publish(m, schemas, names)
    assert set(placed) == {f"few_{n}" for n in names}
    assert _tables(m.warehouse).isdisjoint({"raw", "staging", "intermediate", "marts", "funding_by_cycle"})
    flow = spark.table("few_intermediate.int_contributions_to_candidates")
    assert flow.columns == flows.FLOW_COLUMNS and flow.count() == m.flow.count()
    for layer in schemas.values():
        spark.sql(f"DROP SCHEMA IF EXISTS {layer} CASCADE")


def test_lines_are_split_once_and_never_dealt_by_file(spark):
    lines = spark.createDataFrame(
        [("H1|2022|2022|C1|H|P|L1", 2022, "a.txt"), ('H2|2022|2022|"C|2"|H|P|L2', 2022, "a.txt"),
         ('H3|2022|2022|"C3"|H|P|L3', 2022, "b.txt"), ("H4|2022", 2022, "b.txt")],
        "value string, cycle_year int, source_file string")
    rows = loader.parsed(lines, loader.columns_of(LINK), [(2022, "a.txt")])
    good = rows.filter("reason is null").select("fields", "source_file")
    assert sorted((r.fields[0], r.fields[3]) for r in good.collect()) == [("H1", "C1"), ("H2", "C|2"), ("H3", '"C3"')]
    assert [r.reason for r in rows.filter("reason is not null").collect()] == ["fields"]
    assert "hashpartitioning" not in _plan(good)
    assert good._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1


def test_a_loaded_table_is_read_without_dealing_its_rows(spark, scratch):
    os.makedirs(f"{scratch}/x/2022/ccl")
    with open(f"{scratch}/x/2022/ccl/a.txt", "w") as file:
        file.write("H1|2022|2022|C1|H|P|L1\nH2|2022\n")
    loader.load_filings(spark, f"{scratch}/x", f"{scratch}/wh", [2022], ["ccl"]).collect()
    for df in (loader.read_table(spark, f"{scratch}/wh", LINK), loader.read_quarantine(spark, f"{scratch}/wh", LINK)):
        assert df.count() == 1
        assert "BroadcastHashJoin" in (plan := _plan(df)) and "SortMergeJoin [load" not in plan


def test_percent_ranks_and_filing_files_write_no_raw_table(spark, scratch):
    spark.conf.set("fundflow.warehouse.dir", scratch)
    try:
        for name in ("donation_percent_rank", "filing_manifest"):
            assert queries.queries()[name](spark, SF_SMALL).count() > 0
    finally:
        spark.conf.unset("fundflow.warehouse.dir")
    written = {d for _, folders, _ in os.walk(scratch) for d in folders}
    assert "raw" not in written and "filing-loads" in written
