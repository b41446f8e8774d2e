"""Staging models: typed, decoded, one output row per raw row.

Each function takes the raw DataFrame (all-text columns plus lineage) and
returns a lazy DataFrame; filters and projections fold into the raw scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions.numeric import MONEY, REPORTED
from ..functions.text import (candidate_display_name, candidate_first_name,
                              candidate_last_name, normalize_employer, normalize_name)
from ..operators.dedup import best_per_key


def stg_candidates(raw: DataFrame) -> DataFrame:
    """Latest profile per candidate (highest election year), 17 columns.

    Ties on the year fall to (cycle_year, source_file, whole row), highest
    first.  The key is the trimmed id, so ids differing only by padding
    collapse into one profile.
    """
    year = F.col("cand_election_yr").cast("int")
    return _profile(best_per_key(raw, [F.trim("cand_id")],
                                 [year.desc_nulls_last(), F.col("cycle_year").desc_nulls_last(),
                                  F.col("source_file").desc_nulls_last()]))


def candidate_profiles(raw: DataFrame) -> DataFrame:
    """Every cycle's profile of each candidate: the columns of ``stg_candidates`` plus ``cycle_year``.

    Of several rows in one cycle the one with the highest election year counts, ties as there.
    """
    year = F.col("cand_election_yr").cast("int")
    return _profile(best_per_key(raw, [F.trim("cand_id"), F.col("cycle_year")],
                                 [year.desc_nulls_last(), F.col("source_file").desc_nulls_last()]), "cycle_year")


def _profile(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        F.trim("cand_id").alias("cand_id"),
        F.trim("cand_name").alias("candidate_name_raw"),
        candidate_last_name("cand_name").alias("last_name"),
        candidate_first_name("cand_name").alias("first_name"),
        candidate_display_name("cand_name").alias("candidate_name"),
        F.col("cand_pty_affiliation").alias("party_code"),
        D.decode("cand_pty_affiliation", D.PARTY, D.PARTY_DEFAULT).alias("party_name"),
        F.col("cand_election_yr").cast("int").alias("election_year"),
        F.col("cand_office_st").alias("office_state"),
        D.decode("cand_office", D.OFFICE).alias("office"),
        F.col("cand_office_district").alias("office_district"),
        D.decode("cand_ici", D.INCUMBENCY, D.INCUMBENCY_DEFAULT).alias("incumbent_challenger_status"),
        D.decode("cand_status", D.CANDIDATE_STATUS).alias("candidate_status"),
        F.col("cand_pcc").alias("principal_campaign_committee_id"),
        normalize_name("cand_city").alias("candidate_city"),
        F.col("cand_st").alias("candidate_state"),
        F.col("cand_zip").alias("candidate_zip"),
        *more,
    )


def stg_committees(raw: DataFrame, latest_per_id: bool = False) -> DataFrame:
    """Decoded committees with the Super-PAC flag, 14 columns.

    By default every loaded cycle keeps its row, so a committee present in
    several cycles tags (and multiplies) its transactions once per cycle, as
    in the source.  ``latest_per_id=True`` keeps only its latest cycle's row.
    """
    if latest_per_id:
        raw = best_per_key(raw, [F.trim("cmte_id")],
                           [F.col("cycle_year").desc_nulls_last(),
                            F.col("source_file").desc_nulls_last()])
    return raw.select(
        F.trim("cmte_id").alias("committee_id"),
        F.trim("cmte_nm").alias("committee_name_raw"),
        normalize_name("cmte_nm").alias("committee_name"),
        D.decode("cmte_dsgn", D.COMMITTEE_DESIGNATION).alias("committee_designation"),
        D.decode("cmte_tp", D.COMMITTEE_TYPE).alias("committee_type"),
        (F.col("cmte_tp") == D.SUPER_PAC_TYPE).alias("is_super_pac"),
        F.col("cmte_pty_affiliation").alias("party_code"),
        D.decode("org_tp", D.ORGANIZATION_TYPE, D.ORGANIZATION_DEFAULT).alias("organization_type"),
        F.trim("connected_org_nm").alias("connected_organization_name_raw"),
        normalize_employer("connected_org_nm").alias("connected_organization_name"),
        F.trim("cand_id").alias("candidate_id"),
        normalize_name("cmte_city").alias("committee_city"),
        F.col("cmte_st").alias("committee_state"),
        F.col("cmte_zip").alias("committee_zip"),
    )


def stg_individual_contributions(raw: DataFrame, lenient: bool = False, keep: tuple = ()) -> DataFrame:
    """Typed individual donations plus the size bucket, 21 columns, and the raw columns ``keep``."""
    amount = F.col("transaction_amt").cast(MONEY)
    cleaned = raw.filter(F.col("transaction_amt").isNotNull()).select(
        F.col("sub_id").alias("transaction_id"),
        F.trim("cmte_id").alias("committee_id"),
        F.trim("name").alias("donor_name_raw"),
        F.trim("employer").alias("donor_employer_raw"),
        normalize_name("name").alias("donor_name"),
        normalize_name("city").alias("donor_city"),
        F.col("state").alias("donor_state"),
        F.col("zip_code").alias("donor_zip"),
        normalize_name("occupation").alias("donor_occupation"),
        normalize_employer("employer").alias("donor_employer"),
        amount.alias("amount"),
        D.filing_date("transaction_dt", lenient).alias("transaction_date"),
        F.col("transaction_tp").alias("transaction_type"),
        D.is_refund("transaction_tp", amount).alias("is_refund"),
        F.col("entity_tp").alias("entity_type"),
        (F.col("entity_tp") == "IND").alias("is_individual_donor"),
        F.col("transaction_pgi").alias("election_type"),
        F.col("tran_id").alias("fec_transaction_id"),
        F.col("memo_text").alias("memo"),
        F.col("other_id").alias("earmarked_to_committee_id"),
        *keep,
    )
    return cleaned.withColumn("donation_size_bucket", D.size_bucket("is_refund", "amount"))


def stg_pac_contributions(raw: DataFrame, lenient: bool = False, keep: tuple = ()) -> DataFrame:
    """Typed committee-to-candidate transactions, 17 columns, and the raw columns ``keep``."""
    amount = F.col("transaction_amt").cast(MONEY)
    return raw.filter(F.col("transaction_amt").isNotNull()).select(
        F.col("sub_id").alias("transaction_id"),
        F.trim("cmte_id").alias("contributor_committee_id"),
        F.trim("cand_id").alias("candidate_id"),
        amount.alias("amount"),
        ((amount < 0) | F.col("transaction_tp").startswith(D.REFUND_TYPE_PREFIX)).alias("is_refund"),
        D.filing_date("transaction_dt", lenient).alias("transaction_date"),
        F.col("transaction_tp").alias("transaction_type"),
        F.col("transaction_pgi").alias("election_type"),
        F.col("entity_tp").alias("entity_type"),
        F.trim("name").alias("contributor_name"),
        F.trim("city").alias("contributor_city"),
        F.col("state").alias("contributor_state"),
        F.trim("employer").alias("contributor_employer"),
        F.trim("occupation").alias("contributor_occupation"),
        F.col("other_id").alias("other_committee_id"),
        F.col("tran_id").alias("fec_transaction_id"),
        F.col("memo_text").alias("memo"),
        *keep,
    )


def stg_candidate_committee_linkage(raw: DataFrame) -> DataFrame:
    """Candidate-committee links, 7 columns.  Both ids are trimmed."""
    return raw.select(
        F.col("linkage_id"),
        F.trim("cand_id").alias("candidate_id"),
        F.col("cand_election_yr").cast("int").alias("candidate_election_year"),
        F.col("fec_election_yr").cast("int").alias("fec_election_year"),
        F.trim("cmte_id").alias("committee_id"),
        F.col("cmte_tp").alias("committee_type"),
        D.decode("cmte_dsgn", D.LINKAGE_DESIGNATION).alias("committee_designation"),
    )


_REPORTED_COLUMNS = [
    ("ttl_receipts", "tot_rec"), ("ttl_indiv_contrib", "ind_con"),
    ("other_pol_cmte_contrib", "oth_com_con"), ("pol_pty_contrib", "par_com_con"),
    ("cand_contrib", "can_con"), ("cand_loans", "cand_loans"), ("other_loans", "other_loans"),
    ("ttl_disb", "tot_dis"), ("coh_cop", "cash_on_hand_close"), ("debts_owed_by", "debts_owed"),
    ("indiv_refunds", "ind_ref"), ("cmte_refunds", "cmte_ref"),
]


def stg_candidate_financial_summary(raw: DataFrame) -> DataFrame:
    """Self-reported totals per candidate and cycle, 20 columns."""
    return raw.filter(F.trim("cand_id") != "").select(
        F.trim("cand_id").alias("cand_id"),
        F.trim("cand_name").alias("cand_name_raw"),
        F.trim("cand_ici").alias("cand_ici"),
        F.trim("pty_cd").alias("party_code"),
        F.trim("cand_office_st").alias("cand_state"),
        *[F.col(src).try_cast(REPORTED).alias(dst) for src, dst in _REPORTED_COLUMNS],
        D.report_end_timestamp("cvg_end_dt").alias("coverage_end_date"),
        F.col("cycle_year").alias("fec_election_yr"),
        F.col("cycle_year"),
    )
