"""Unified money flow: every dollar resolved to its receiving candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY_SUM
from .tagging import (UNCLASSIFIED_GROUP, UNCLASSIFIED_INDUSTRY, UNCLASSIFIED_SOURCE,
                      tag_donations)

FLOW_COLUMNS = [
    "transaction_id", "candidate_id", "source_committee_id", "donor_name", "donor_employer",
    "donor_occupation", "amount", "transaction_date", "election_type", "contribution_path",
    "industry", "industry_group", "match_source", "is_dark_money_suspect", "is_super_pac",
]
_TEXT = "string"


def pac_direct(pac: DataFrame, tags: DataFrame, keep: tuple = ()) -> DataFrame:
    """Committee -> candidate path; tags are not defaulted (missing stays NULL)."""
    t = tags.select(F.col("committee_id").alias("_tag_id"), "industry", "industry_group",
                    "match_source", "is_dark_money_suspect", "is_super_pac")
    p = pac.filter(~F.col("is_refund"))
    joined = p.join(t, p["contributor_committee_id"] == t["_tag_id"],
                    "left")
    return joined.select(
        "transaction_id", "candidate_id",
        F.col("contributor_committee_id").alias("source_committee_id"),
        F.lit(None).cast(_TEXT).alias("donor_name"),
        F.lit(None).cast(_TEXT).alias("donor_employer"),
        F.lit(None).cast(_TEXT).alias("donor_occupation"),
        "amount", "transaction_date", "election_type",
        F.lit("pac_direct").alias("contribution_path"),
        "industry", "industry_group", "match_source", "is_dark_money_suspect",
        F.coalesce(F.col("is_super_pac"), F.lit(False)).alias("is_super_pac"),
        *keep,
    )


def individual_via_committee(individual: DataFrame, linkage: DataFrame,
                             taxonomy: DataFrame,
                             keywords: list[tuple] | None = None,
                             tagged: DataFrame | None = None,
                             dedupe_links: bool = False, keep: tuple = ()) -> DataFrame:
    """Donor -> committee -> candidate path, employer-tagged in place.

    Each linked candidate of the receiving committee is credited; repeated
    links credit again unless ``dedupe_links``.  The employer tag is computed on the donation row
    itself, which equals joining the per-donation tag table back on the
    transaction id whenever transaction ids are unique (checked by dq).
    """
    links = linkage.select(F.col("committee_id").alias("_link_cmte"), "candidate_id")
    if dedupe_links:
        # one credit per (committee, candidate) however often the link repeats
        links = links.distinct()
    # tag each donation once, before the fan-out to its linked candidates
    if tagged is None:
        tagged = tag_donations(individual, taxonomy, keywords)
    joined = tagged.join(links,
                         tagged["committee_id"] == links["_link_cmte"], "inner")
    hit = F.col("m").isNotNull()
    return joined.select(
        "transaction_id", "candidate_id",
        F.col("committee_id").alias("source_committee_id"),
        "donor_name", "donor_employer", "donor_occupation",
        "amount", "transaction_date", "election_type",
        F.lit("individual").alias("contribution_path"),
        F.when(hit, F.col("m.industry")).otherwise(F.lit(UNCLASSIFIED_INDUSTRY)).alias("industry"),
        F.when(hit, F.col("m.industry_group")).otherwise(F.lit(UNCLASSIFIED_GROUP))
        .alias("industry_group"),
        F.when(hit, F.lit("employer_keyword")).otherwise(F.lit(UNCLASSIFIED_SOURCE))
        .alias("match_source"),
        F.lit(False).alias("is_dark_money_suspect"),
        F.lit(False).alias("is_super_pac"),
        *keep,
    )


def contributions_to_candidates(pac: DataFrame, individual: DataFrame, linkage: DataFrame,
                                tags: DataFrame, taxonomy: DataFrame,
                                keywords: list[tuple] | None = None,
                                tagged: DataFrame | None = None,
                                dedupe_links: bool = False, keep: tuple = ()) -> DataFrame:
    """UNION ALL of both paths, 15 columns, and the columns ``keep`` that both paths have."""
    individuals = individual_via_committee(individual, linkage, taxonomy, keywords, tagged,
                                           dedupe_links, keep)
    columns = [*FLOW_COLUMNS, *keep]
    return pac_direct(pac, tags, keep).select(*columns).unionByName(individuals.select(*columns))


def pair_sums(flow: DataFrame) -> DataFrame:
    """(candidate_id, source_committee_id, amount, n_rows): the flow summed per pair."""
    return flow.groupBy("candidate_id", "source_committee_id").agg(
        F.sum("amount").cast(MONEY_SUM).alias("amount"), F.count(F.lit(1)).alias("n_rows"))
