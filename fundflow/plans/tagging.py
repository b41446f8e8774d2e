"""Industry tags for committees (crosswalk, then keyword) and donors (employer)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import best_per_key
from ..operators.keyword_match import (add_first_match, collect_taxonomy, first_match_index,
                                         match_at)

UNCLASSIFIED_INDUSTRY = "Unknown / Unclassified"
UNCLASSIFIED_GROUP = "Unknown"
UNCLASSIFIED_SOURCE = "unclassified"

# ---------------------------------------------------------------------------
# Employer texts treated as "no employer" (compared, trimmed,
# with the normalised Title-Case employer, so in practice only '' is caught).
# ---------------------------------------------------------------------------
EMPLOYER_STOP_LIST = ["", "N/A", "NA", "NONE", "NOT EMPLOYED", "RETIRED", "SELF",
                      "SELF EMPLOYED", "SELF-EMPLOYED", "HOMEMAKER"]


def crosswalk_matches(committees: DataFrame, crosswalk_raw: DataFrame,
                      categories: DataFrame) -> DataFrame:
    """Layer 1: committee -> crosswalk -> category; best category per committee."""
    ids = committees.select("committee_id")
    xw = crosswalk_raw.select(F.upper(F.trim("fec_id")).alias("_fec"),
                              F.upper(F.trim("prim_code")).alias("_code"))
    cats = categories.select(F.upper(F.trim("opensecrets_catcode")).alias("_cat"),
                             "opensecrets_catcode", "industry", "industry_group", "priority")
    joined = (ids.join(xw,
                       F.upper(F.trim(ids["committee_id"])) == xw["_fec"])
              .join(cats, F.col("_code") == F.col("_cat")))
    best = best_per_key(
        joined.select("committee_id", "industry", "industry_group", "priority",
                      "opensecrets_catcode"),
        ["committee_id"],
        [F.col("priority").asc_nulls_last(), F.col("opensecrets_catcode").asc_nulls_last()])
    return best.select("committee_id", "industry", "industry_group",
                       F.lit("opensecrets").alias("match_source"))


def keyword_matches(committees: DataFrame, taxonomy: DataFrame,
                    keywords: list[tuple] | None = None, whole_words: bool = False) -> DataFrame:
    """Layer 2: best keyword over committee name or connected organisation.

    ``whole_words`` ignores hits inside longer words.
    """
    texts = [F.col("committee_name"), F.coalesce(F.col("connected_organization_name"), F.lit(""))]
    if keywords is None:
        keywords = collect_taxonomy(taxonomy)
    if keywords is not None:
        # best keyword = smallest match index: an int hash aggregate per committee
        idx = (committees.select("committee_id", first_match_index(texts, keywords, whole_words).alias("_i"))
               .filter(F.col("_i").isNotNull())
               .groupBy("committee_id").agg(F.min("_i").alias("_i")))
        m = match_at(F.col("_i"), keywords)
        return idx.select("committee_id", m.industry.alias("industry"),
                          m.industry_group.alias("industry_group"),
                          F.lit("committee_keyword").alias("match_source"))
    matched = add_first_match(committees.select("committee_id", "committee_name",
                                                "connected_organization_name"),
                              texts, taxonomy, "m", whole_words=whole_words).filter(F.col("m").isNotNull())
    best = best_per_key(matched.select("committee_id", "m"), ["committee_id"],
                        [F.col("m.priority").asc_nulls_last(), F.col("m.keyword").asc_nulls_last()])
    return best.select("committee_id", F.col("m.industry").alias("industry"),
                       F.col("m.industry_group").alias("industry_group"),
                       F.lit("committee_keyword").alias("match_source"))


def committee_industry_tags(committees: DataFrame, taxonomy: DataFrame,
                            crosswalk_raw: DataFrame, categories: DataFrame,
                            keywords: list[tuple] | None = None, whole_words: bool = False) -> DataFrame:
    """One row per committee row with its industry tag and dark-money flag, 11 columns.
    """
    xw = crosswalk_matches(committees, crosswalk_raw, categories)
    kw = keyword_matches(committees, taxonomy, keywords, whole_words)
    # crosswalk wins: one full outer join of the two per-committee tables
    # (each at most one row per committee) keeps the crosswalk row when there
    # is one and the keyword row otherwise
    x = xw.select(F.col("committee_id").alias("_x_id"), F.col("industry").alias("_x_ind"),
                  F.col("industry_group").alias("_x_grp"), F.col("match_source").alias("_x_src"))
    k = kw.select(F.col("committee_id").alias("_k_id"), F.col("industry").alias("_k_ind"),
                  F.col("industry_group").alias("_k_grp"), F.col("match_source").alias("_k_src"))
    has_x = F.col("_x_id").isNotNull()
    best = x.join(k, x["_x_id"] == k["_k_id"], "full").select(
        F.coalesce("_x_id", "_k_id").alias("_bm_id"),
        F.when(has_x, F.col("_x_ind")).otherwise(F.col("_k_ind")).alias("_ind"),
        F.when(has_x, F.col("_x_grp")).otherwise(F.col("_k_grp")).alias("_grp"),
        F.when(has_x, F.col("_x_src")).otherwise(F.col("_k_src")).alias("_src"))
    c = committees
    tagged = c.join(best, c["committee_id"] == best["_bm_id"],
                    "left")
    return tagged.select(
        "committee_id", "committee_name", "connected_organization_name", "organization_type",
        "committee_type", "committee_designation", "is_super_pac",
        F.coalesce("_ind", F.lit(UNCLASSIFIED_INDUSTRY)).alias("industry"),
        F.coalesce("_grp", F.lit(UNCLASSIFIED_GROUP)).alias("industry_group"),
        F.coalesce("_src", F.lit(UNCLASSIFIED_SOURCE)).alias("match_source"),
        (F.col("is_super_pac") & F.col("_ind").isNull()).alias("is_dark_money_suspect"),
    )


def employer_eligible(stop_list: list[str] = EMPLOYER_STOP_LIST, casefold: bool = False):
    """Employer present and not on the stop list.

    The list is upper case while employers are normalised to Title Case, so
    by default only '' is caught (as in the source); ``casefold=True``
    compares case-insensitively and also drops "Retired", "Self Employed", ...
    """
    emp = F.col("donor_employer")
    if casefold:
        return emp.isNotNull() & ~F.upper(F.trim(emp)).isin([s.upper() for s in stop_list])
    return emp.isNotNull() & ~F.trim(emp).isin(stop_list)


def tag_donations(individual: DataFrame, taxonomy: DataFrame,
                  keywords: list[tuple] | None = None, casefold_stop_list: bool = False,
                  whole_words: bool = False) -> DataFrame:
    """Individual, non-refund donations with their employer match ``m``.

    ``m`` is NULL when the employer is missing, on the stop list or matches
    no keyword.  Both the donor-industry table and the money flow read this,
    so the keyword scan runs once per donation.
    """
    donations = individual.filter(F.col("is_individual_donor") & ~F.col("is_refund"))
    tagged = add_first_match(donations, [F.col("donor_employer")], taxonomy, "m",
                             keywords=keywords, whole_words=whole_words)
    return tagged.withColumn("m", F.when(employer_eligible(casefold=casefold_stop_list),
                                         F.col("m")))


def individual_donor_industry(individual: DataFrame, taxonomy: DataFrame,
                              keywords: list[tuple] | None = None,
                              tagged: DataFrame | None = None,
                              casefold_stop_list: bool = False) -> DataFrame:
    """Employer-based industry per individual, non-refund donation, 9 columns.

    ``tagged``: the output of ``tag_donations`` when already computed.
    """
    if tagged is None:
        tagged = tag_donations(individual, taxonomy, keywords, casefold_stop_list)
    m = tagged.filter(employer_eligible(casefold=casefold_stop_list))
    return m.select(
        "transaction_id", "committee_id", "amount", "transaction_date", "donor_employer",
        F.coalesce(F.col("m.industry"), F.lit(UNCLASSIFIED_INDUSTRY)).alias("industry"),
        F.coalesce(F.col("m.industry_group"), F.lit(UNCLASSIFIED_GROUP)).alias("industry_group"),
        F.col("m.keyword").alias("matched_keyword"),
        F.when(F.col("m.industry").isNotNull(), F.lit("employer_keyword"))
        .otherwise(F.lit(UNCLASSIFIED_SOURCE)).alias("match_source"),
    )


def dark_money_suspects(tags: DataFrame) -> DataFrame:
    return tags.filter(F.col("is_dark_money_suspect")).select(
        "committee_id", "committee_name", "connected_organization_name",
        "organization_type", "committee_type")
