"""Per-cycle grain: as-of profiles, sums that add up to the plain marts, ranks over any column."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fundflow.operators.asof import as_of_join
from fundflow.operators.median import median_of_integers
from fundflow.operators.ranking import ntile_distributed, percent_rank_distributed
from fundflow.plans.pipeline import Models


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(5)
    left = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, *range(12)])) for i in range(200)]
    right = [(rng.choice(["a", "b", None]), rng.choice([None, *range(12)]), i) for i in range(25)]
    got = as_of_join(spark.createDataFrame(left, "id int, k string, t int"),
                     spark.createDataFrame(right, "rk string, rt int, v int"), [("k", "rk")], ("t", "rt"), ["v", "rt"],
                     [F.col("v").desc()])
    want = {}
    for i, k, t in left:
        fit = [(rt, v) for rk, rt, v in right if None not in (k, t, rk, rt) and rk == k and rt <= t]
        want[i] = max(fit) if fit else (None, None)
    rows = got.collect()
    assert got.columns == ["id", "k", "t", "v", "rt"] and len(rows) == len(left)
    assert {r.id: (r.rt, r.v) for r in rows} == want


def test_as_of_join_of_empty_sides(spark):
    left, right = spark.createDataFrame([("a", 1)], "k string, t int"), spark.createDataFrame([], "rk string, rt int, v int")
    assert [tuple(r) for r in as_of_join(left, right, [("k", "rk")], ("t", "rt"), ["v"]).collect()] == [("a", 1, None)]
    assert as_of_join(left.filter("false"), right, [("k", "rk")], ("t", "rt"), ["v"]).count() == 0


@pytest.mark.parametrize("part", [[], ["g"]])
def test_percent_rank_of_many_distinct_values(spark, part):
    rng = random.Random(2)
    rows = [(i, rng.choice(["x", "x", "x", "y", None]), rng.choice([None, 1.5, 2.5, rng.random()])) for i in range(3000)]
    df = spark.createDataFrame(rows + [(9999, "alone", 1.0)], "id int, g string, v double")
    got = {r.id: r.p for r in percent_rank_distributed(df, part, "v", "p").collect()}
    w = Window.partitionBy(*part).orderBy(F.col("v").asc_nulls_last())
    assert got == {r.id: r.p for r in df.withColumn("p", F.percent_rank().over(w)).collect()}


def test_percent_rank_plan_has_no_window_over_whole_partitions(spark):
    df = spark.range(1000).withColumn("v", F.rand(1))
    plan = percent_rank_distributed(df, [], "v", "p")._jdf.queryExecution().executedPlan().toString()
    assert "_pid" in plan and "SinglePartition" not in plan.split("value-histogram")[0].split("Window [sum(_c")[0]


def test_composite_keys(spark):
    df = spark.createDataFrame([(c, i % 3, i) for i in range(60) for c in ("a", None)], "c string, g int, v int")
    got = {(r.c, r.g): r.m for r in median_of_integers(df, ["c", "g"], "v", "m").collect()}
    want = {(r.c, r.g): int(r.m) for r in df.groupBy("c", "g").agg(F.percentile("v", F.lit(0.5)).alias("m")).collect()}
    assert got == want
    tiles = ntile_distributed(df, ["g"], ["v"], ["c", "v"], 4, "n").groupBy("g", "n").count().collect()
    assert {r["count"] for r in tiles} == {10}


def test_cycles_add_up_to_the_plain_summary(spark):
    m = Models.from_lens(spark, SF_SMALL)
    money = ["total_transactions", "total_raised", "raised_from_pacs", "raised_from_individuals", "unclassified_amount"]
    by = m.funding_by_cycle.groupBy("candidate_id").agg(*[F.sum(c).alias(c) for c in money]).collect()
    plain = m.funding.select("candidate_id", *money).collect()
    assert {tuple(r) for r in by} == {tuple(r) for r in plain}
    cycles = m.funding_by_cycle.select("cycle_year", "candidate_id")
    assert cycles.distinct().count() == cycles.count() > len(plain)


def test_profile_of_a_cycle_is_not_a_later_one(spark):
    from fundflow.plans import marts, staging
    from fundflow.sources.layouts import CN_COLUMNS, raw_schema
    blank = dict.fromkeys(CN_COLUMNS)
    rows = [{**blank, "cand_id": "H1", "cand_name": f"DOE, Y{y}", "cand_election_yr": str(y), "cycle_year": y,
             "source_file": "cn"} for y in (2000, 2004)]
    profiles = staging.candidate_profiles(spark.createDataFrame(rows, raw_schema(CN_COLUMNS)))
    flow = Models.from_lens(spark, SF_SMALL).flow_by_cycle.limit(1)
    flows = [flow.withColumn("candidate_id", F.lit("H1")).withColumn("cycle_year", F.lit(y)) for y in (1998, 2000, 2002, 2004)]
    whole = flows[0].unionByName(flows[1]).unionByName(flows[2]).unionByName(flows[3])
    fin = Models.from_lens(spark, SF_SMALL).financials
    got = {r.cycle_year: (r.candidate_name, r.election_year, r.has_candidate_profile)
           for r in marts.funding_by_cycle(whole, profiles, fin).collect()}
    assert got == {1998: ("H1", None, False), 2000: ("Y2000 Doe", 2000, True), 2002: ("Y2000 Doe", 2000, True),
                   2004: ("Y2004 Doe", 2004, True)}
