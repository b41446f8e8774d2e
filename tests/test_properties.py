"""Invariants of the marts and shape of the physical plans."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.plans import reports
from fundflow.plans.pipeline import Models


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_mart_invariants(spark):
    m = Models.from_lens(spark, SF_SMALL)
    f = m.funding
    bad = f.filter(F.col("raised_from_pacs") + F.col("raised_from_individuals")
                   != F.col("total_raised")).count()
    assert bad == 0
    s = m.score
    assert s.filter((F.col("corruption_score") < 0) | (F.col("corruption_score") > 100)).count() == 0
    assert s.filter(F.col("score_decile_within_office").isNull()).count() == 0
    sizes = (s.groupBy("election_year", "office", "score_decile_within_office").count()
             .groupBy("election_year", "office")
             .agg((F.max("count") - F.min("count")).alias("spread"),
                  F.count(F.lit(1)).alias("deciles"), F.sum("count").alias("n")))
    for r in sizes.collect():
        assert r.spread <= 1 or r.deciles < 10, r
    assert s.count() == s.select("candidate_id").distinct().count()


def test_results_do_not_depend_on_broadcasts(spark):
    """Flow, funding and a report with every join sort-merged, the hot committee's skew split."""
    names = ["money_flow", "funding_summary", "industry_totals", "top_recipients", "committee_tags"]

    def results():
        m = Models.from_lens(spark, SF_SMALL)
        frames = [m.flow, m.funding, reports.industry_totals(m.flow, m.committee_tags, m.score),
                  reports.top_recipients(m.flow, m.committee_tags, m.candidates, m.score), m.committee_tags]
        return frames, [sorted(map(str, f.collect())) for f in frames]

    frames, usual = results()
    keep = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
        frames, merged = results()
        plan = _plan(frames[0])
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    for name, a, b in zip(names, usual, merged):
        assert a == b, name


def test_no_base_table_goes_to_one_task(spark):
    m = Models.from_lens(spark, SF_SMALL)
    for df in (m.flow, m.committee_tags, m.donor_industry):
        assert "SinglePartition" not in _plan(df)


def test_funding_plan_has_no_object_aggregate(spark):
    m = Models.from_lens(spark, SF_SMALL)
    plan = _plan(m.funding)
    assert "ObjectHashAggregate" not in plan
    assert "SortAggregate" not in plan
    assert "HashAggregate" in plan


def test_scan_prunes_columns(spark):
    m = Models.from_lens(spark, SF_SMALL)
    plan = _plan(m.individual.select("transaction_id", "amount"))
    scan = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    # events.props (a JSON text column) is never needed, so it is never read
    assert scan and all("props" not in line for line in scan)
