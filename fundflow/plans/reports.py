"""Report queries over the marts, flow and tags.

Parameters are Python values bound as Column literals (never pasted into SQL
text).  Every ``limit`` is a top-k report; ties at the cut are broken by the
grouping keys so the rows returned are reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM, exact_avg
from .flows import pair_sums
from .tagging import UNCLASSIFIED_INDUSTRY

MAJOR_PARTIES = ["Democrat", "Republican"]


def _dec1_avg(c: str):
    return exact_avg(c, scale=1)


def overview(score: DataFrame) -> DataFrame:
    """R-01: candidates, cycles, money in the system, average score."""
    return score.agg(
        F.count_distinct("candidate_id").alias("total_candidates"),
        F.count_distinct("election_year").alias("cycles_covered"),
        F.sum("total_raised").cast(MONEY_SUM).alias("total_money"),
        _dec1_avg("corruption_score").alias("avg_corruption_score"))


TOP_COLUMNS = ["candidate_name", "party_name", "office", "office_state", "election_year",
               "total_raised", "pct_from_pacs", "pct_dark_money", "corruption_score",
               "risk_tier", "score_pct_within_office"]


def top_captured(score: DataFrame, n: int = 20) -> DataFrame:
    """R-02: highest scores."""
    return (score.orderBy(F.col("corruption_score").desc(), F.col("candidate_id").asc())
            .limit(n).select(*TOP_COLUMNS))


def party_totals(score: DataFrame, parties: list[str] = MAJOR_PARTIES) -> DataFrame:
    """R-03 (as intended: the score mart alone carries every column it needs)."""
    return (score.filter(F.col("party_name").isin(parties)).groupBy("party_name").agg(
        F.count_distinct("candidate_id").alias("candidates"),
        F.sum("total_raised").cast(MONEY_SUM).alias("total_raised"),
        _dec1_avg("corruption_score").alias("avg_score"),
        exact_avg("pct_from_pacs").alias("avg_pct_pacs"),
        exact_avg("pct_dark_money").alias("avg_pct_dark_money"))
        .orderBy(F.col("total_raised").desc_nulls_last(), "party_name"))


def tier_by_office(score: DataFrame) -> DataFrame:
    """R-04."""
    return (score.groupBy("risk_tier", "office").agg(F.count(F.lit(1)).alias("candidates"))
            .orderBy(F.col("office").asc_nulls_last(), F.col("candidates").desc(), "risk_tier"))


LEADERBOARD_COLUMNS = [
    "candidate_name", "party_name", "office", "office_state", "election_year", "total_raised",
    "pct_from_pacs", "pct_from_individuals", "pct_dark_money", "pct_super_pac",
    "median_individual_donation", "pct_individual_from_large", "unique_donor_count",
    "corruption_score", "score_pct_within_office", "score_decile_within_office", "risk_tier"]


def _filtered(score: DataFrame, office: str, party: str, year: str | None) -> DataFrame:
    cond = F.col("office").like(office) & F.col("party_name").like(party)
    if year is not None:
        cond = cond & F.col("election_year").cast("string").like(year)
    return score.filter(cond)


def leaderboard(score: DataFrame, office: str = "%", party: str = "%", year: str = "%",
                n: int = 100) -> DataFrame:
    """R-05: LIKE filters ('%' = all); a NULL year never matches."""
    return (_filtered(score, office, party, year)
            .orderBy(F.col("corruption_score").desc(), F.col("candidate_id").asc())
            .limit(n).select(*LEADERBOARD_COLUMNS))


def score_histogram(score: DataFrame, office: str = "%", party: str = "%",
                    width: float = 5.0) -> DataFrame:
    """R-06: score distribution by party in bins of ``width`` points."""
    b = F.floor(F.col("corruption_score") / width).cast("long")
    return (_filtered(score, office, party, None)
            .groupBy(b.alias("bin"), "party_name")
            .agg(F.count(F.lit(1)).alias("candidates"))
            .withColumn("bin_start", F.col("bin") * width))


def _flow_tags(flow: DataFrame, tags: DataFrame) -> DataFrame:
    """Money and rows per candidate and committee with the committee's tags.

    ``flow`` may be the flow itself or its ``pair_sums`` table.  It is summed (map-side first)
    before any join, so the joins run per committee-candidate pair, not per transaction;
    ``n_rows`` keeps row-weighted averages exact.
    """
    t = tags.select(F.col("committee_id").alias("_t_id"), "industry_group",
                    F.col("committee_name").alias("_t_name"),
                    F.col("connected_organization_name").alias("_t_org"),
                    F.col("organization_type").alias("_t_orgtype"),
                    F.col("is_dark_money_suspect").alias("_t_dark"))
    f = flow if "n_rows" in flow.columns else pair_sums(flow)
    return f.join(t, f["source_committee_id"] == t["_t_id"])


def _score_slim(score: DataFrame) -> DataFrame:
    return score.select(F.col("candidate_id").alias("_s_id"), "corruption_score", "risk_tier")


def industry_totals(flow: DataFrame, tags: DataFrame, score: DataFrame,
                    exclude_group: str = UNCLASSIFIED_INDUSTRY) -> DataFrame:
    """R-07: money per industry group over flow x committee tags x score.

    The exclusion compares the *group* with the unclassified *industry* label,
    so (as in the source report) it removes nothing; pass "Unknown" to drop
    unclassified money.
    """
    ft = _flow_tags(flow, tags).filter(F.col("industry_group") != exclude_group)
    s = _score_slim(score)
    j = ft.join(s, ft["candidate_id"] == s["_s_id"])
    score_tenths = F.col("corruption_score").cast("decimal(10,1)")    # the average is per flow row
    return j.groupBy("industry_group").agg(
        F.count_distinct("candidate_id").alias("candidates_funded"),
        F.sum("amount").cast(MONEY_SUM).alias("total_contributed"),
        (F.sum(score_tenths * F.col("n_rows")).cast("double")
         / F.nullif(F.sum(F.when(score_tenths.isNotNull(), F.col("n_rows"))), F.lit(0)))
        .alias("avg_candidate_score")).orderBy(
        F.col("total_contributed").desc_nulls_last(), "industry_group")


def _cand_slim(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("cand_id").alias("_c_id"),
                             F.col("candidate_name").alias("_c_name"),
                             F.col("party_name").alias("_c_party"),
                             F.col("office").alias("_c_office"),
                             F.col("office_state").alias("_c_state"),
                             F.col("election_year").alias("_c_year"))


def industry_by_party(flow: DataFrame, tags: DataFrame, candidates: DataFrame,
                      exclude_group: str = UNCLASSIFIED_INDUSTRY,
                      parties: list[str] = MAJOR_PARTIES) -> DataFrame:
    """R-08."""
    ft = _flow_tags(flow, tags).filter(F.col("industry_group") != exclude_group)
    c = _cand_slim(candidates).filter(F.col("_c_party").isin(parties))
    j = ft.join(c, ft["candidate_id"] == c["_c_id"])
    return j.groupBy("industry_group", F.col("_c_party").alias("party_name")).agg(
        F.sum("amount").cast(MONEY_SUM).alias("total")).orderBy(
        F.col("total").desc_nulls_last(), "industry_group", "party_name")


def top_recipients(flow: DataFrame, tags: DataFrame, candidates: DataFrame, score: DataFrame,
                   industry_group: str = "Pharma & Healthcare", n: int = 25) -> DataFrame:
    """R-09: biggest recipients of one industry group's money."""
    ft = _flow_tags(flow, tags).filter(F.col("industry_group") == industry_group)
    c = _cand_slim(candidates)
    s = _score_slim(score)
    j = (ft.join(c, ft["candidate_id"] == c["_c_id"])
         .join(s, F.col("candidate_id") == s["_s_id"]))
    keys = [F.col("_c_name").alias("candidate_name"), F.col("_c_party").alias("party_name"),
            F.col("_c_office").alias("office"), F.col("_c_state").alias("office_state"),
            F.col("_c_year").alias("election_year"), "corruption_score", "risk_tier"]
    g = j.groupBy(*keys).agg(F.sum("amount").cast(MONEY_SUM).alias("received"))
    order = [F.col("received").desc()] + [F.col(c).asc_nulls_last() for c in (
        "candidate_name", "party_name", "office", "office_state", "election_year",
        "corruption_score", "risk_tier")]
    return g.orderBy(*order).limit(n)


def dark_overview(tags: DataFrame, funding: DataFrame, score: DataFrame) -> DataFrame:
    """R-10 as intended: three independent scalar aggregates, one row."""
    pacs = tags.filter(F.col("is_dark_money_suspect")).agg(
        F.count_distinct("committee_id").alias("dark_money_pacs"))
    money = funding.agg(F.sum("raised_from_dark_money").cast(MONEY_SUM).alias("total_dark_money"))
    pct = score.agg(exact_avg("pct_dark_money").alias("avg_pct_dark_money"))
    key = F.lit(1).alias("_k")
    return (pacs.select(key, "*").join(money.select(key, "*"), "_k")
            .join(pct.select(key, "*"), "_k").drop("_k"))


def dark_overview_literal(tags: DataFrame, funding: DataFrame, score: DataFrame) -> DataFrame:
    """R-10 as written: every funding row is repeated once per suspect committee.

    Computed without forming the product: the sum is scaled by the number of
    suspect rows and the average is unchanged by the repetition.
    """
    pacs = tags.filter(F.col("is_dark_money_suspect")).agg(
        F.count_distinct("committee_id").alias("dark_money_pacs"),
        F.count(F.lit(1)).alias("_rows"))
    f = funding.select("candidate_id", "raised_from_dark_money")
    s = score.select(F.col("candidate_id").alias("_s_id"), "pct_dark_money")
    pct_dec = F.col("pct_dark_money").cast("decimal(20,2)")
    fs = f.join(s, f["candidate_id"] == s["_s_id"]).agg(
        F.sum("raised_from_dark_money").cast(MONEY_SUM).alias("_sum"),
        F.sum(pct_dec).alias("_pct_sum"), F.count(pct_dec).alias("_pct_n"),
        F.count(F.lit(1)).alias("_n"))
    key = F.lit(1).alias("_k")
    j = pacs.select(key, "*").join(fs.select(key, "*"), "_k")
    any_rows = (F.col("_rows") > 0) & (F.col("_n") > 0)
    return j.select(
        F.when(any_rows, F.col("dark_money_pacs")).otherwise(F.lit(0)).cast("long")
        .alias("dark_money_pacs"),
        F.when(any_rows, (F.col("_sum") * F.col("_rows")).cast(MONEY_SUM)).alias("total_dark_money"),
        # average over the repeated rows, computed the way the product would be
        F.when(any_rows, (F.col("_pct_sum") * F.col("_rows")).cast("double")
               / F.nullif(F.col("_pct_n") * F.col("_rows"), F.lit(0)))
        .alias("avg_pct_dark_money"))


def dark_committees(tags: DataFrame, flow: DataFrame, n: int = 50) -> DataFrame:
    """R-11: suspect committees by money sent."""
    ft = _flow_tags(flow, tags).filter(F.col("_t_dark"))
    g = ft.groupBy(F.col("_t_name").alias("committee_name"),
                   F.col("_t_org").alias("connected_organization_name"),
                   F.col("_t_orgtype").alias("organization_type")).agg(
        F.count_distinct("candidate_id").alias("candidates_funded"),
        F.sum("amount").cast(MONEY_SUM).alias("total_spent"))
    return g.orderBy(F.col("total_spent").desc(), F.col("committee_name").asc_nulls_last(),
                     F.col("connected_organization_name").asc_nulls_last(),
                     F.col("organization_type").asc_nulls_last()).limit(n)


DARK_CANDIDATE_COLUMNS = ["candidate_name", "party_name", "office", "office_state",
                          "election_year", "raised_from_dark_money", "pct_dark_money",
                          "corruption_score", "risk_tier"]


def dark_candidates(funding: DataFrame, score: DataFrame, n: int = 50) -> DataFrame:
    """R-12."""
    f = funding.select(F.col("candidate_id").alias("_f_id"), "raised_from_dark_money") \
        .filter(F.col("raised_from_dark_money") > 0)
    j = score.join(f, score["candidate_id"] == f["_f_id"])
    return (j.orderBy(F.col("raised_from_dark_money").desc(), F.col("candidate_id").asc())
            .limit(n).select(*DARK_CANDIDATE_COLUMNS))


PROFILE_COLUMNS = [
    "candidate_name", "party_name", "office", "office_state", "election_year",
    "incumbent_challenger_status", "total_raised", "pct_from_pacs", "pct_from_individuals",
    "pct_dark_money", "pct_super_pac", "unique_donor_count", "median_individual_donation",
    "pct_individual_from_large", "corruption_score", "score_pct_within_office",
    "score_decile_within_office", "risk_tier"]
INDUSTRY_FUNDING = ["raised_from_pharma", "raised_from_finance", "raised_from_defense",
                    "raised_from_energy", "raised_from_tech", "raised_from_aipac_aligned"]


def _pick_candidate(score: DataFrame, name: str) -> DataFrame:
    """The one candidate a name search resolves to: latest year, then id."""
    return (score.filter(F.col("candidate_name").ilike(f"%{name}%"))
            .orderBy(F.col("election_year").desc_nulls_last(), F.col("candidate_id").asc())
            .limit(1))


def profile(score: DataFrame, funding: DataFrame, name: str) -> DataFrame:
    """R-13."""
    one = _pick_candidate(score, name)
    f = funding.select(F.col("candidate_id").alias("_f_id"), *INDUSTRY_FUNDING)
    return one.join(f, one["candidate_id"] == f["_f_id"]).select(*PROFILE_COLUMNS,
                                                                 *INDUSTRY_FUNDING)


def funding_mix(score: DataFrame, name: str) -> DataFrame:
    """R-14 as intended: the matched candidate's three shares as rows."""
    one = _pick_candidate(score, name).select(
        F.col("pct_from_pacs").alias("PACs"), F.col("pct_from_individuals").alias("Individuals"),
        F.col("pct_dark_money").alias("Dark Money"))
    return one.unpivot([], ["PACs", "Individuals", "Dark Money"], "source", "pct")


# component label, column, sign, kind
COMPONENTS = [
    ("PAC Concentration", "penalty_pac_concentration", 1, "penalty"),
    ("Dark Money", "penalty_dark_money", 1, "penalty"),
    ("Industry Capture", "penalty_industry_capture", 1, "penalty"),
    ("Super PAC", "penalty_super_pac", 1, "penalty"),
    ("Large Donors", "penalty_large_donors", 1, "penalty"),
    ("Individual % Bonus", "bonus_individual_pct", -1, "bonus"),
    ("Donor Distribution Bonus", "bonus_donor_distribution", -1, "bonus"),
]


def component_breakdown(score: DataFrame, name: str) -> DataFrame:
    """R-16 as intended: score components of the matched candidate, bonuses negated."""
    one = _pick_candidate(score, name).select(
        *[(F.col(c) * sign if sign < 0 else F.col(c)).alias(label)
          for label, c, sign, _ in COMPONENTS])
    long = one.unpivot([], [label for label, _, _, _ in COMPONENTS], "component", "value")
    kinds = F.create_map(*[x for label, _, _, kind in COMPONENTS for x in (F.lit(label), F.lit(kind))])
    return long.withColumn("type", kinds[F.col("component")])


def industry_breakdown(flow: DataFrame, tags: DataFrame, candidates: DataFrame, name: str,
                       exclude_group: str = UNCLASSIFIED_INDUSTRY) -> DataFrame:
    """R-15: one name search's money by industry group."""
    ft = _flow_tags(flow, tags).filter(F.col("industry_group") != exclude_group)
    c = _cand_slim(candidates).filter(F.col("_c_name").ilike(f"%{name}%"))
    j = ft.join(c, ft["candidate_id"] == c["_c_id"])
    return j.groupBy("industry_group").agg(F.sum("amount").cast(MONEY_SUM).alias("total")).orderBy(
        F.col("total").desc_nulls_last(), "industry_group")


def top_by_office(score: DataFrame, office: str = "Senate", n: int = 20) -> DataFrame:
    """R-17: top scores within one office."""
    return (score.filter(F.col("office") == office)
            .orderBy(F.col("corruption_score").desc(), F.col("candidate_id").asc()).limit(n)
            .select("candidate_name", "party_name", "office_state", "total_raised",
                    "pct_from_pacs", "corruption_score", "risk_tier"))
