"""Raw file layouts of the bulk filings (pipe-delimited, no header).

Every data column is read as text; the loader adds ``cycle_year`` (int) and
``source_file`` (text) so each row keeps its lineage.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column order of each bulk file type, as published with the
# files.  They must stay exactly like this for the positional reads to work.
# ---------------------------------------------------------------------------
INDIV_COLUMNS = [
    "cmte_id", "amndt_ind", "rpt_tp", "transaction_pgi", "image_num",
    "transaction_tp", "entity_tp", "name", "city", "state", "zip_code",
    "employer", "occupation", "transaction_dt", "transaction_amt",
    "other_id", "tran_id", "file_num", "memo_cd", "memo_text", "sub_id",
]
PAS2_COLUMNS = [
    "cmte_id", "amndt_ind", "rpt_tp", "transaction_pgi", "image_num",
    "transaction_tp", "entity_tp", "name", "city", "state", "zip_code",
    "employer", "occupation", "transaction_dt", "transaction_amt",
    "other_id", "cand_id", "tran_id", "file_num", "memo_cd", "memo_text", "sub_id",
]
CN_COLUMNS = [
    "cand_id", "cand_name", "cand_pty_affiliation", "cand_election_yr",
    "cand_office_st", "cand_office", "cand_office_district", "cand_ici",
    "cand_status", "cand_pcc", "cand_st1", "cand_st2", "cand_city",
    "cand_st", "cand_zip",
]
CM_COLUMNS = [
    "cmte_id", "cmte_nm", "tres_nm", "cmte_st1", "cmte_st2", "cmte_city",
    "cmte_st", "cmte_zip", "cmte_dsgn", "cmte_tp", "cmte_pty_affiliation",
    "cmte_filing_freq", "org_tp", "connected_org_nm", "cand_id",
]
CCL_COLUMNS = [
    "cand_id", "cand_election_yr", "fec_election_yr",
    "cmte_id", "cmte_tp", "cmte_dsgn", "linkage_id",
]
WEBALL_COLUMNS = [
    "cand_id", "cand_name", "cand_ici", "pty_cd", "cand_pty_affiliation",
    "ttl_receipts", "trans_from_auth", "ttl_disb", "trans_to_auth",
    "coh_bop", "coh_cop", "cand_contrib", "cand_loans", "other_loans",
    "cand_loan_repay", "other_loan_repay", "debts_owed_by",
    "ttl_indiv_contrib", "cand_office_st", "cand_office_district",
    "spec_election", "prim_election", "run_election", "gen_election",
    "gen_election_precent", "other_pol_cmte_contrib", "pol_pty_contrib",
    "cvg_end_dt", "indiv_refunds", "cmte_refunds",
]
CROSSWALK_COLUMNS = [
    "cycle", "fec_id", "pac_short", "affiliate", "ultorg", "recip_id",
    "recip_code", "fec_cand_id", "party", "prim_code", "source", "sensitive",
    "foreign", "active",
]

# file type key -> (raw table name, column list)
FILE_TYPES: dict[str, tuple[str, list[str]]] = {
    "indiv": ("individual_contributions", INDIV_COLUMNS),
    "pas2": ("pac_contributions", PAS2_COLUMNS),
    "cn": ("candidates", CN_COLUMNS),
    "cm": ("committees", CM_COLUMNS),
    "ccl": ("candidate_committee_linkage", CCL_COLUMNS),
    "weball": ("candidate_financial_summary", WEBALL_COLUMNS),
}
OPTIONAL_TABLES: dict[str, list[str]] = {"opensecrets_committees": CROSSWALK_COLUMNS}

RAW_TABLES = [name for name, _ in FILE_TYPES.values()] + list(OPTIONAL_TABLES)
LINEAGE_COLUMNS = ["cycle_year", "source_file"]

# Cycle domain: even years 1980 through 2024.
ALL_CYCLES = list(range(1980, 2025, 2))


def text_schema(columns: list[str]) -> T.StructType:
    """All-text schema of one file layout (no lineage columns)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def raw_schema(columns: list[str]) -> T.StructType:
    """Schema of a raw table: the file's text columns plus lineage."""
    return T.StructType(
        text_schema(columns).fields
        + [T.StructField("cycle_year", T.IntegerType(), True),
           T.StructField("source_file", T.StringType(), True)])


def columns_of(table: str) -> list[str]:
    for name, cols in FILE_TYPES.values():
        if name == table:
            return cols
    return OPTIONAL_TABLES[table]


def check_cycles(cycles) -> list[int]:
    """Validate requested cycle years against the published domain."""
    bad = [c for c in cycles if c not in ALL_CYCLES]
    if bad:
        raise ValueError(f"cycle years must be even years 1980-2024, got {bad}")
    return sorted(set(cycles))
