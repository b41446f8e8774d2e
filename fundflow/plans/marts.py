"""Per-candidate funding summary and the 0-100 donor-capture score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY, MONEY_SUM, pct, ratio, round_to
from ..operators.asof import as_of_join
from ..operators.joins import null_safe_on
from ..operators.median import median_of_integers
from ..operators.ranking import ntile_distributed, percent_rank_by_histogram

# ---------------------------------------------------------------------------
# Industry groups with their own funding column.
# ---------------------------------------------------------------------------
INDUSTRY_COLUMNS = [
    ("raised_from_pharma", "Pharma & Healthcare"),
    ("raised_from_finance", "Finance & Banking"),
    ("raised_from_defense", "Defense & Military"),
    ("raised_from_energy", "Energy & Oil"),
    ("raised_from_tech", "Tech & Telecom"),
    ("raised_from_aipac_aligned", "Israel / AIPAC-aligned"),
]
MATCH_SOURCE_COLUMNS = [
    ("classified_by_opensecrets", "opensecrets"),
    ("classified_by_employer", "employer_keyword"),
    ("classified_by_keyword", "committee_keyword"),
    ("unclassified_amount", "unclassified"),
]
LARGE_DONATION = 1000

# ---------------------------------------------------------------------------
# Score weights and caps, risk tier bounds, ranking buckets.
# ---------------------------------------------------------------------------
PAC_WEIGHT, PAC_CAP = 0.70, 70
DARK_WEIGHT, DARK_CAP = 0.50, 40
SUPER_PAC_WEIGHT, SUPER_PAC_CAP = 0.30, 20
LARGE_WEIGHT, LARGE_CAP = 0.30, 30
INDUSTRY_WEIGHT, INDUSTRY_CAP = 0.20, 20
INDIVIDUAL_BONUS_WEIGHT, INDIVIDUAL_BONUS_CAP = 0.15, 15
MEDIAN_SCALE, DISTRIBUTION_HALF, DISTRIBUTION_CAP = 1000, 5, 10
HIGH_RISK_FROM, MODERATE_RISK_FROM = 45, 15
SCORE_DECILES = 10

FUNDING_COLUMNS = [
    "candidate_id", "candidate_name", "party_name", "office", "office_state", "election_year",
    "incumbent_challenger_status", "has_candidate_profile", "total_transactions",
    "total_raised", "total_receipts_reported", "ind_total_reported", "pct_coverage",
    "financial_report_thru", "raised_from_pacs", "raised_from_individuals",
    *[c for c, _ in INDUSTRY_COLUMNS], "raised_from_dark_money", "raised_from_super_pacs",
    *[c for c, _ in MATCH_SOURCE_COLUMNS], "pct_classified", "unique_donor_count",
    "median_individual_donation", "pct_individual_from_large", "pct_from_pacs",
    "pct_from_individuals", "pct_dark_money", "pct_super_pac",
]

SCORE_COLUMNS = [
    "candidate_id", "candidate_name", "party_name", "office", "office_state", "election_year",
    "incumbent_challenger_status", "total_raised", "pct_from_pacs", "pct_from_individuals",
    "pct_dark_money", "pct_super_pac", "unique_donor_count", "median_individual_donation",
    "pct_individual_from_large", "pct_large_donors", "pct_top_industry",
    "penalty_pac_concentration", "penalty_dark_money", "penalty_super_pac",
    "penalty_large_donors", "penalty_industry_capture", "bonus_individual_pct",
    "bonus_donor_distribution", "corruption_score", "score_pct_within_office",
    "score_decile_within_office", "score_pct_overall", "risk_tier",
]


def _sum_when(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("amount")).otherwise(F.lit(0))).cast(MONEY_SUM)


def candidate_funding_aggregates(flow: DataFrame, keys: tuple = ("candidate_id",)) -> DataFrame:
    """Per candidate (or per ``keys``): counts, the 14 conditional sums, distinct donors, median.

    Three aggregates, each a plain hash aggregate with a map-side partial
    step, joined on the keys (NULL ids kept, null-safe):

    * the sums over all flow rows grouped by candidate;
    * distinct donor names: (candidate, donor) groups first, then a count per
      candidate, so a candidate with a third of the rows is spread by donor;
    * the exact median of individual amounts from a (candidate, cents)
      histogram (see ``median_of_integers``).
    """
    path = F.col("contribution_path")
    indiv = path == "individual"
    sums = flow.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("total_raised"),
        _sum_when(path == "pac_direct").alias("raised_from_pacs"),
        _sum_when(indiv).alias("raised_from_individuals"),
        *[_sum_when(F.col("industry_group") == g).alias(c) for c, g in INDUSTRY_COLUMNS],
        _sum_when(F.col("is_dark_money_suspect")).alias("raised_from_dark_money"),
        _sum_when(F.col("is_super_pac")).alias("raised_from_super_pacs"),
        *[_sum_when(F.col("match_source") == s).alias(c) for c, s in MATCH_SOURCE_COLUMNS],
        _sum_when(indiv & (F.col("amount") >= LARGE_DONATION)).alias("_large_individual"),
        F.sum(F.when(indiv, F.col("amount"))).cast(MONEY_SUM).alias("_individual_total"),
    )
    individual = flow.filter(indiv)
    donors = (individual.filter(F.col("donor_name").isNotNull())
              .groupBy(*keys, "donor_name").agg(F.count(F.lit(1)).alias("_d"))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_donor_count")))
    cents = individual.select(*keys, (F.col("amount") * 100).cast("long").alias("_cents"))
    median = median_of_integers(cents, list(keys), "_cents", "_median_cents")
    d = donors.select(*[F.col(k).alias(f"_d_{k}") for k in keys], "unique_donor_count")
    m = median.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "_median_cents")
    out = (sums.join(d, null_safe_on(sums, d, [(k, f"_d_{k}") for k in keys]), "left")
           .join(m, null_safe_on(sums, m, [(k, f"_m_{k}") for k in keys]), "left"))
    return out.select(
        *[c for c in sums.columns if not c.startswith("_")],
        F.coalesce(F.col("unique_donor_count"), F.lit(0)).cast("long").alias("unique_donor_count"),
        (F.col("_median_cents").cast("decimal(20,0)") / F.lit(100)).cast(MONEY)
        .alias("median_individual_donation"),
        "_large_individual", "_individual_total")


def funding_with_extras(flow: DataFrame, candidates: DataFrame, financials: DataFrame) -> DataFrame:
    """Funding summary plus ``large_donor_total`` used by the score.

    Money is aggregated per candidate id first and the profile is joined
    afterwards: the profile table has one row per id, so this equals grouping
    by id and profile fields, while only one row per candidate is shuffled.
    """
    agg = candidate_funding_aggregates(flow)
    prof = _profile_fields(candidates)
    a = _with_profile_defaults(agg.join(prof, agg["candidate_id"] == prof["_cand_id"], "left"),
                               ["candidate_id"], agg.columns)
    fs = _reported(financials)
    w = a.join(fs, (a["candidate_id"] == fs["_fs_id"])
               & (a["election_year"] == fs["_fs_yr"]), "left")
    return _with_shares(w, ["candidate_id"])


def funding_by_cycle(flow: DataFrame, profiles: DataFrame, financials: DataFrame) -> DataFrame:
    """The funding summary per candidate and cycle: ``cycle_year``, its columns and ``large_donor_total``.

    Money belongs to the cycle of its transaction, so a candidate's cycles add up to the one row of
    the plain summary.  The profile is the latest that is not after the cycle; reported totals are
    those of the cycle itself.
    """
    keys = ["cycle_year", "candidate_id"]
    agg = candidate_funding_aggregates(flow, tuple(keys))
    prof = _profile_fields(profiles, "cycle_year")
    fields = [c for c in prof.columns if c != "cycle_year"]
    a = _with_profile_defaults(as_of_join(agg, prof, [("candidate_id", "_cand_id")], ("cycle_year", "cycle_year"),
                                          fields), keys, agg.columns)
    fs = _reported(financials)
    w = a.join(fs, (a["candidate_id"] == fs["_fs_id"]) & (a["cycle_year"] == fs["_fs_yr"]), "left")
    return _with_shares(w, keys)


def _profile_fields(candidates: DataFrame, *more: str) -> DataFrame:
    return candidates.select(
        F.col("cand_id").alias("_cand_id"), F.col("candidate_name").alias("_name"),
        F.col("party_name").alias("_party"), F.col("office").alias("_office"),
        F.col("office_state").alias("_state"), F.col("election_year"),
        F.col("incumbent_challenger_status").alias("_ici"), *more)


def _with_profile_defaults(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return rows.select(
        *keys,
        F.coalesce("_name", "candidate_id").alias("candidate_name"),
        F.coalesce("_party", F.lit("Unknown")).alias("party_name"),
        F.coalesce("_office", F.lit("Unknown")).alias("office"),
        F.coalesce("_state", F.lit("Unknown")).alias("office_state"),
        "election_year",
        F.coalesce("_ici", F.lit("Unknown")).alias("incumbent_challenger_status"),
        F.col("_cand_id").isNotNull().alias("has_candidate_profile"),
        *[c for c in measures if c not in keys])


def _reported(financials: DataFrame) -> DataFrame:
    return financials.select(F.col("cand_id").alias("_fs_id"), F.col("fec_election_yr").alias("_fs_yr"),
                             F.col("tot_rec").alias("total_receipts_reported"),
                             F.col("ind_con").alias("ind_total_reported"),
                             F.col("coverage_end_date").alias("financial_report_thru"))


def _with_shares(w: DataFrame, keys: list[str]) -> DataFrame:
    """Funding columns, the shares included, and ``large_donor_total``."""
    effective = F.coalesce(F.col("total_receipts_reported").cast(MONEY_SUM), F.col("total_raised"))
    w = w.withColumn("_effective_total", effective)
    return w.select(
        *[c for c in keys if c != "candidate_id"],
        *[c for c in FUNDING_COLUMNS if c not in (
            "pct_coverage", "pct_classified", "pct_individual_from_large", "pct_from_pacs",
            "pct_from_individuals", "pct_dark_money", "pct_super_pac")
          and c != "financial_report_thru"],
        "financial_report_thru",
        pct("total_raised", "total_receipts_reported").alias("pct_coverage"),
        pct(F.col("total_raised") - F.col("unclassified_amount"), "total_raised")
        .alias("pct_classified"),
        pct("_large_individual", "_individual_total").alias("pct_individual_from_large"),
        pct("raised_from_pacs", "_effective_total").alias("pct_from_pacs"),
        pct("raised_from_individuals", "_effective_total").alias("pct_from_individuals"),
        pct("raised_from_dark_money", "_effective_total").alias("pct_dark_money"),
        pct("raised_from_super_pacs", "_effective_total").alias("pct_super_pac"),
        # large-donor money per candidate; NULL ids never match a candidate row
        F.when(F.col("candidate_id").isNotNull(), F.col("_large_individual"))
        .alias("large_donor_total"),
    )


def score_components(funding: DataFrame, keep: tuple = ()) -> DataFrame:
    """Penalties, bonuses and the clamped 0-100 score (no rankings yet), and the columns ``keep``."""
    f = funding
    total = F.col("total_raised")
    large = F.coalesce(F.col("large_donor_total"), F.lit(0))
    top_industry = F.greatest(*[F.col(c) for c, _ in INDUSTRY_COLUMNS])
    pct_large_ind = F.coalesce(F.col("pct_individual_from_large"), F.lit(100.0))
    median = F.col("median_individual_donation")
    pct_large = pct(large, total)
    comp = f.select(
        *keep, "candidate_id", "candidate_name", "party_name", "office", "office_state",
        "election_year", "incumbent_challenger_status", "total_raised", "pct_from_pacs",
        "pct_from_individuals", "pct_dark_money", "pct_super_pac", "unique_donor_count",
        F.coalesce(median, F.lit(0).cast(MONEY)).alias("median_individual_donation"),
        pct_large_ind.alias("pct_individual_from_large"),
        pct_large.alias("pct_large_donors"),
        pct(top_industry, total).alias("pct_top_industry"),
        F.least(F.col("pct_from_pacs") * PAC_WEIGHT, F.lit(float(PAC_CAP)))
        .alias("penalty_pac_concentration"),
        F.least(F.col("pct_dark_money") * DARK_WEIGHT, F.lit(float(DARK_CAP)))
        .alias("penalty_dark_money"),
        F.least(F.col("pct_super_pac") * SUPER_PAC_WEIGHT, F.lit(float(SUPER_PAC_CAP)))
        .alias("penalty_super_pac"),
        F.least(pct_large * LARGE_WEIGHT, F.lit(float(LARGE_CAP))).alias("penalty_large_donors"),
        F.least(ratio(top_industry, total) * 100 * INDUSTRY_WEIGHT, F.lit(float(INDUSTRY_CAP)))
        .alias("penalty_industry_capture"),
        F.least(F.col("pct_from_individuals") * INDIVIDUAL_BONUS_WEIGHT
                * F.greatest(F.lit(0.0), F.lit(1.0) - pct_large_ind / 100.0),
                F.lit(float(INDIVIDUAL_BONUS_CAP))).alias("bonus_individual_pct"),
        F.greatest(F.lit(0.0), F.least(
            (F.lit(MEDIAN_SCALE) - F.least(F.coalesce(median, F.lit(MEDIAN_SCALE).cast(MONEY)),
                                           F.lit(MEDIAN_SCALE).cast(MONEY))).cast("double")
            / float(MEDIAN_SCALE) * float(DISTRIBUTION_HALF)
            + (F.lit(1.0) - F.least(pct_large_ind, F.lit(100.0)) / 100.0) * float(DISTRIBUTION_HALF),
            F.lit(float(DISTRIBUTION_CAP)))).alias("bonus_donor_distribution"),
    )
    net = (F.col("penalty_pac_concentration") + F.col("penalty_dark_money")
           + F.col("penalty_super_pac") + F.col("penalty_large_donors")
           + F.col("penalty_industry_capture") - F.col("bonus_individual_pct")
           - F.col("bonus_donor_distribution"))
    score = F.greatest(F.lit(0.0), F.least(round_to(net, 1), F.lit(100.0)))
    tier = (F.when(F.col("corruption_score") >= HIGH_RISK_FROM, F.lit("High Risk"))
            .when(F.col("corruption_score") >= MODERATE_RISK_FROM, F.lit("Moderate Risk"))
            .otherwise(F.lit("Lower Risk")))
    return comp.withColumn("corruption_score", score).withColumn("risk_tier", tier)


def candidate_capture_score(funding_extras: DataFrame) -> DataFrame:
    """29 columns: components, score, office/year and overall rankings, tier.

    Rankings order by (score, candidate_id); the id breaks ties so deciles
    are reproducible.  Both are computed without a single-partition window.
    """
    return _ranked(score_components(funding_extras), ["election_year", "office"], [], ["candidate_id"])


def capture_score_by_cycle(funding_cycles: DataFrame) -> DataFrame:
    """The score per candidate and cycle, ranked within (cycle, office) and within the cycle."""
    comp = score_components(funding_cycles, ("cycle_year",))
    return _ranked(comp, ["cycle_year", "office"], ["cycle_year"], ["cycle_year", "candidate_id"])


def _ranked(comp: DataFrame, office: list[str], overall: list[str], keys: list[str]) -> DataFrame:
    ranked = ntile_distributed(comp, office, ["corruption_score"], keys, SCORE_DECILES,
                               "score_decile_within_office")
    ranked = percent_rank_by_histogram(ranked, office, "corruption_score", "_pr_office")
    ranked = percent_rank_by_histogram(ranked, overall, "corruption_score", "_pr_all")
    return ranked.select(
        *[c for c in keys if c != "candidate_id"],
        *[c for c in SCORE_COLUMNS if c not in (
            "score_pct_within_office", "score_decile_within_office", "score_pct_overall",
            "risk_tier")],
        round_to(F.col("_pr_office") * 100, 1).alias("score_pct_within_office"),
        "score_decile_within_office",
        round_to(F.col("_pr_all") * 100, 1).alias("score_pct_overall"),
        "risk_tier",
    )


def large_donor_totals(individual: DataFrame, linkage: DataFrame) -> DataFrame:
    """Per linked candidate: money from donations of $1,000+ and all individual money.

    The score folds the same sum into the funding pass; this standalone form
    is the per-candidate table on its own.
    """
    links = linkage.select(F.col("committee_id").alias("_link_cmte"), "candidate_id")
    d = individual.filter(F.col("is_individual_donor") & ~F.col("is_refund"))
    j = d.join(links, d["committee_id"] == links["_link_cmte"])
    return j.groupBy("candidate_id").agg(
        _sum_when(F.col("amount") >= LARGE_DONATION).alias("large_donor_total"),
        F.sum("amount").cast(MONEY_SUM).alias("individual_total"))
