"""DuckDB SQL for every registered query: the independent oracle.

The text is built from the same lens SQL as the Spark side (so both engines
read identical raw rows) followed by a chain of CTEs that re-derives each
model in plain SQL: window ``QUALIFY`` for the best rows, a keyword cross
product ranked by (priority, keyword), join-then-group marts and the real
window functions for the rankings.  The Spark code uses different plans
(inline matching, aggregate-then-join, histogram ranks); agreement of the two
is what the correctness check measures.
"""

from __future__ import annotations

import re
from functools import reduce

from ..functions import decode as D
from ..functions.text import CORPORATE_SUFFIXES
from ..plans import marts as M
from ..plans.tagging import EMPLOYER_STOP_LIST
from ..sources import seeds
from ..sources.lens import LENS_TABLES, lens_sql


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str, mapping: dict[str, str], default: str | None = None) -> str:
    arms = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    other = col if default is None else _q(default)
    return f"(CASE {col} {arms} ELSE {other} END)"


def _words_title(expr: str) -> str:
    return (f"array_to_string(list_transform(regexp_split_to_array({expr}, ' +'), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def tc(col: str) -> str:
    """Title case; blank/NULL -> NULL."""
    t = f"trim({col})"
    return f"(CASE WHEN coalesce({t}, '') = '' THEN NULL ELSE {_words_title(f'lower({t})')} END)"


def emp(col: str) -> str:
    """Employer normalisation; '' stays ''."""
    spaced = f"regexp_replace(lower(trim({col})), '\\s+', ' ', 'g')"
    titled = (f"array_to_string(list_transform(string_split({spaced}, ' '), "
              f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")
    anded = f"regexp_replace({titled}, '\\s*&\\s*', ' And ', 'g')"
    alts = "|".join(s + "\\.?" for s in CORPORATE_SUFFIXES)
    return f"regexp_replace({anded}, '\\s+({alts})$', '', 'i')"


def _name_part(col: str, i: int) -> str:
    return tc(f"trim(split_part({col}, ',', {i}))")


def last_name(col: str) -> str:
    return f"(CASE WHEN strpos({col}, ',') > 0 THEN {_name_part(col, 1)} ELSE {tc(col)} END)"


def first_name(col: str) -> str:
    return f"(CASE WHEN strpos({col}, ',') > 0 THEN {_name_part(col, 2)} END)"


def display_name(col: str) -> str:
    return (f"(CASE WHEN strpos({col}, ',') > 0 THEN {_name_part(col, 2)} || ' ' || "
            f"{_name_part(col, 1)} ELSE {tc(col)} END)")


def _values(rows, names) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


def _pct(num: str, den: str, places: int = 2) -> str:
    return f"round(({num}) / nullif({den}, 0) * 100, {places})"


def _mmddyyyy(col: str) -> str:
    return f"(CASE WHEN length({col}) = 8 THEN strptime({col}, '%m%d%Y')::date END)"


_PROFILE = ("candidate_name", "party_name", "office", "office_state", "election_year",
            "incumbent_challenger_status")


def _by_cycle(chain: str) -> str:
    """The chain with each transaction's cycle kept through the flow, and the per-cycle marts after it."""
    for before, after in (
            ("other_id AS earmarked_to_committee_id\n    FROM r_indiv",
             "other_id AS earmarked_to_committee_id, cycle_year\n    FROM r_indiv"),
            ("memo_text AS memo\n    FROM r_pac", "memo_text AS memo, cycle_year\n    FROM r_pac"),
            ("AS is_super_pac\n    FROM s_pac p LEFT JOIN", "AS is_super_pac, p.cycle_year\n    FROM s_pac p LEFT JOIN"),
            ("false, false\n    FROM s_indiv i", "false, false, i.cycle_year\n    FROM s_indiv i")):
        assert chain.count(before) == 1, before
        chain = chain.replace(before, after)
    part = {name: re.search(rf"\n{name} AS \((.*?)\n\)(?:,|$)", chain, re.S)[1]
            for name in ("s_cand", "fund_agg", "funding", "parts", "scored", "score")}
    swap = lambda text, *pairs: reduce(lambda t, p: t.replace(*p), pairs, text)
    profiles = swap(part["s_cand"], ("    FROM r_cand", ", cycle_year\n    FROM r_cand"),
                    ("PARTITION BY trim(cand_id)", "PARTITION BY trim(cand_id), cycle_year"))
    # the latest profile not after the cycle, found by a plain inequality join
    latest = f"""
    SELECT k.candidate_id, k.cycle_year, {', '.join('p.' + c for c in _PROFILE)}, p.cand_id
    FROM (SELECT DISTINCT candidate_id, cycle_year FROM flow) k
    JOIN profile_cycle p ON p.cand_id = k.candidate_id AND p.cycle_year <= k.cycle_year
    QUALIFY row_number() OVER (PARTITION BY k.candidate_id, k.cycle_year ORDER BY p.cycle_year DESC) = 1"""
    agg = swap(part["fund_agg"], ("SELECT f.candidate_id,", "SELECT f.cycle_year, f.candidate_id,"),
               ("LEFT JOIN s_cand c ON c.cand_id = f.candidate_id",
                "LEFT JOIN latest_profile c ON c.candidate_id = f.candidate_id AND c.cycle_year = f.cycle_year"))
    funding = swap(part["funding"], ("SELECT a.candidate_id,", "SELECT a.cycle_year, a.candidate_id,"),
                   ("FROM fund_agg a", "FROM fund_agg_cycle a"),
                   ("s.fec_election_yr = a.election_year", "s.fec_election_yr = a.cycle_year"))
    large = """
    SELECT l.candidate_id, i.cycle_year, sum(i.amount) FILTER (WHERE i.amount >= 1000) AS large_donor_total
    FROM s_indiv i JOIN s_link l ON l.committee_id = i.committee_id
    WHERE i.is_individual_donor AND NOT i.is_refund GROUP BY l.candidate_id, i.cycle_year"""
    parts = swap(part["parts"], ("SELECT f.candidate_id,", "SELECT f.cycle_year, f.candidate_id,"),
                 ("FROM funding f LEFT JOIN large_totals g ON g.candidate_id = f.candidate_id",
                  "FROM funding_cycle f LEFT JOIN large_cycle g ON g.candidate_id = f.candidate_id "
                  "AND g.cycle_year = f.cycle_year"))
    score = swap(part["score"], ("PARTITION BY election_year, office", "PARTITION BY cycle_year, office"),
                 ("OVER (ORDER BY corruption_score)", "OVER (PARTITION BY cycle_year ORDER BY corruption_score)"),
                 ("FROM scored", "FROM scored_cycle"))
    more = {"profile_cycle": profiles, "latest_profile": latest, "fund_agg_cycle": agg, "funding_cycle": funding,
            "large_cycle": large, "parts_cycle": parts,
            "scored_cycle": part["scored"].replace("FROM parts", "FROM parts_cycle"), "score_cycle": score}
    return chain + "".join(f",\n{name} AS ({text}\n)" for name, text in more.items())


def ctes() -> str:
    raw = {t: lens_sql(t, "duckdb") for t in LENS_TABLES}
    tax = _values(seeds.taxonomy_rows() + seeds.LENS_KEYWORDS,
                  ["keyword", "industry", "industry_group", "priority"])
    cats = _values(seeds.LENS_CATEGORIES,
                   ["opensecrets_catcode", "industry", "industry_group", "priority"])
    stop = ", ".join(_q(s) for s in EMPLOYER_STOP_LIST)
    ind_sums = ",\n        ".join(
        f"coalesce(sum(amount) FILTER (WHERE industry_group = {_q(g)}), 0) AS {c}"
        for c, g in M.INDUSTRY_COLUMNS)
    src_sums = ",\n        ".join(
        f"coalesce(sum(amount) FILTER (WHERE match_source = {_q(s)}), 0) AS {c}"
        for c, s in M.MATCH_SOURCE_COLUMNS)
    top_ind = "greatest(" + ", ".join(c for c, _ in M.INDUSTRY_COLUMNS) + ")"
    return f"""
r_cand AS ({raw['candidates']}),
r_cmte AS ({raw['committees']}),
r_pac AS ({raw['pac_contributions']}),
r_indiv AS ({raw['individual_contributions']}),
r_link AS ({raw['candidate_committee_linkage']}),
r_fin AS ({raw['candidate_financial_summary']}),
r_xwalk AS ({raw['opensecrets_committees']}),
kw AS {tax},
cat AS {cats},
s_cand AS (
    SELECT trim(cand_id) AS cand_id,
        trim(cand_name) AS candidate_name_raw,
        {last_name('cand_name')} AS last_name,
        {first_name('cand_name')} AS first_name,
        {display_name('cand_name')} AS candidate_name,
        cand_pty_affiliation AS party_code,
        {_case('cand_pty_affiliation', D.PARTY, D.PARTY_DEFAULT)} AS party_name,
        CAST(cand_election_yr AS INTEGER) AS election_year,
        cand_office_st AS office_state,
        {_case('cand_office', D.OFFICE)} AS office,
        cand_office_district AS office_district,
        {_case('cand_ici', D.INCUMBENCY, D.INCUMBENCY_DEFAULT)} AS incumbent_challenger_status,
        {_case('cand_status', D.CANDIDATE_STATUS)} AS candidate_status,
        cand_pcc AS principal_campaign_committee_id,
        {tc('cand_city')} AS candidate_city,
        cand_st AS candidate_state,
        cand_zip AS candidate_zip
    FROM r_cand
    QUALIFY row_number() OVER (
        PARTITION BY trim(cand_id)
        ORDER BY CAST(cand_election_yr AS INTEGER) DESC NULLS LAST, cycle_year DESC NULLS LAST,
                 source_file DESC NULLS LAST, cand_id, cand_name, cand_pty_affiliation,
                 cand_election_yr, cand_office_st, cand_office, cand_office_district, cand_ici,
                 cand_status, cand_pcc, cand_st1, cand_st2, cand_city, cand_st, cand_zip) = 1
),
s_cmte AS (
    SELECT trim(cmte_id) AS committee_id,
        trim(cmte_nm) AS committee_name_raw,
        {tc('cmte_nm')} AS committee_name,
        {_case('cmte_dsgn', D.COMMITTEE_DESIGNATION)} AS committee_designation,
        {_case('cmte_tp', D.COMMITTEE_TYPE)} AS committee_type,
        cmte_tp = 'O' AS is_super_pac,
        cmte_pty_affiliation AS party_code,
        {_case('org_tp', D.ORGANIZATION_TYPE, D.ORGANIZATION_DEFAULT)} AS organization_type,
        trim(connected_org_nm) AS connected_organization_name_raw,
        {emp('connected_org_nm')} AS connected_organization_name,
        trim(cand_id) AS candidate_id,
        {tc('cmte_city')} AS committee_city,
        cmte_st AS committee_state,
        cmte_zip AS committee_zip
    FROM r_cmte
),
s_indiv_base AS (
    SELECT sub_id AS transaction_id,
        trim(cmte_id) AS committee_id,
        trim(name) AS donor_name_raw,
        trim(employer) AS donor_employer_raw,
        {tc('name')} AS donor_name,
        {tc('city')} AS donor_city,
        state AS donor_state,
        zip_code AS donor_zip,
        {tc('occupation')} AS donor_occupation,
        {emp('employer')} AS donor_employer,
        CAST(transaction_amt AS DECIMAL(12,2)) AS amount,
        {_mmddyyyy('transaction_dt')} AS transaction_date,
        transaction_tp AS transaction_type,
        (starts_with(transaction_tp, '22') OR CAST(transaction_amt AS DECIMAL(12,2)) < 0)
            AS is_refund,
        entity_tp AS entity_type,
        entity_tp = 'IND' AS is_individual_donor,
        transaction_pgi AS election_type,
        tran_id AS fec_transaction_id,
        memo_text AS memo,
        other_id AS earmarked_to_committee_id
    FROM r_indiv WHERE transaction_amt IS NOT NULL
),
s_indiv AS (
    SELECT *, CASE WHEN is_refund THEN 'refund'
                   WHEN amount < 200 THEN 'small'
                   WHEN amount >= 200 AND amount <= 999 THEN 'medium'
                   WHEN amount >= 1000 AND amount <= 2999 THEN 'large'
                   WHEN amount >= 3000 THEN 'major' END AS donation_size_bucket
    FROM s_indiv_base
),
s_pac AS (
    SELECT sub_id AS transaction_id,
        trim(cmte_id) AS contributor_committee_id,
        trim(cand_id) AS candidate_id,
        CAST(transaction_amt AS DECIMAL(12,2)) AS amount,
        (CAST(transaction_amt AS DECIMAL(12,2)) < 0 OR starts_with(transaction_tp, '22'))
            AS is_refund,
        {_mmddyyyy('transaction_dt')} AS transaction_date,
        transaction_tp AS transaction_type,
        transaction_pgi AS election_type,
        entity_tp AS entity_type,
        trim(name) AS contributor_name,
        trim(city) AS contributor_city,
        state AS contributor_state,
        trim(employer) AS contributor_employer,
        trim(occupation) AS contributor_occupation,
        other_id AS other_committee_id,
        tran_id AS fec_transaction_id,
        memo_text AS memo
    FROM r_pac WHERE transaction_amt IS NOT NULL
),
s_link AS (
    SELECT linkage_id, trim(cand_id) AS candidate_id,
        CAST(cand_election_yr AS INTEGER) AS candidate_election_year,
        CAST(fec_election_yr AS INTEGER) AS fec_election_year,
        trim(cmte_id) AS committee_id, cmte_tp AS committee_type,
        {_case('cmte_dsgn', D.LINKAGE_DESIGNATION)} AS committee_designation
    FROM r_link
),
s_fin AS (
    SELECT trim(cand_id) AS cand_id, trim(cand_name) AS cand_name_raw,
        trim(cand_ici) AS cand_ici, trim(pty_cd) AS party_code,
        trim(cand_office_st) AS cand_state,
        TRY_CAST(ttl_receipts AS DECIMAL(18,2)) AS tot_rec,
        TRY_CAST(ttl_indiv_contrib AS DECIMAL(18,2)) AS ind_con,
        TRY_CAST(other_pol_cmte_contrib AS DECIMAL(18,2)) AS oth_com_con,
        TRY_CAST(pol_pty_contrib AS DECIMAL(18,2)) AS par_com_con,
        TRY_CAST(cand_contrib AS DECIMAL(18,2)) AS can_con,
        TRY_CAST(cand_loans AS DECIMAL(18,2)) AS cand_loans,
        TRY_CAST(other_loans AS DECIMAL(18,2)) AS other_loans,
        TRY_CAST(ttl_disb AS DECIMAL(18,2)) AS tot_dis,
        TRY_CAST(coh_cop AS DECIMAL(18,2)) AS cash_on_hand_close,
        TRY_CAST(debts_owed_by AS DECIMAL(18,2)) AS debts_owed,
        TRY_CAST(indiv_refunds AS DECIMAL(18,2)) AS ind_ref,
        TRY_CAST(cmte_refunds AS DECIMAL(18,2)) AS cmte_ref,
        try_strptime(nullif(trim(cvg_end_dt), ''), '%m/%d/%Y') AS coverage_end_date,
        cycle_year AS fec_election_yr,
        cycle_year
    FROM r_fin WHERE trim(cand_id) <> ''
),
xw_best AS (
    SELECT c.committee_id, g.industry, g.industry_group
    FROM s_cmte c
    JOIN r_xwalk x ON upper(trim(x.fec_id)) = upper(trim(c.committee_id))
    JOIN cat g ON upper(trim(g.opensecrets_catcode)) = upper(trim(x.prim_code))
    QUALIFY row_number() OVER (PARTITION BY c.committee_id
                               ORDER BY g.priority NULLS LAST, g.opensecrets_catcode) = 1
),
kw_best AS (
    SELECT c.committee_id, k.industry, k.industry_group
    FROM s_cmte c, kw k
    WHERE contains(lower(c.committee_name), lower(k.keyword))
       OR contains(lower(coalesce(c.connected_organization_name, '')), lower(k.keyword))
    QUALIFY row_number() OVER (PARTITION BY c.committee_id ORDER BY k.priority, k.keyword) = 1
),
tag_pick AS (
    SELECT committee_id, industry, industry_group, 'opensecrets' AS match_source FROM xw_best
    UNION ALL
    SELECT b.committee_id, b.industry, b.industry_group, 'committee_keyword'
    FROM kw_best b WHERE NOT EXISTS (SELECT 1 FROM xw_best x WHERE x.committee_id = b.committee_id)
),
tags AS (
    SELECT c.committee_id, c.committee_name, c.connected_organization_name,
        c.organization_type, c.committee_type, c.committee_designation, c.is_super_pac,
        coalesce(p.industry, 'Unknown / Unclassified') AS industry,
        coalesce(p.industry_group, 'Unknown') AS industry_group,
        coalesce(p.match_source, 'unclassified') AS match_source,
        c.is_super_pac AND p.industry IS NULL AS is_dark_money_suspect
    FROM s_cmte c LEFT JOIN tag_pick p ON p.committee_id = c.committee_id
),
donor_pool AS (
    SELECT * FROM s_indiv
    WHERE is_individual_donor AND NOT is_refund AND donor_employer IS NOT NULL
      AND trim(donor_employer) NOT IN ({stop})
),
-- per employer, so donations that share a transaction id are tagged each on its own (Q-24)
donor_hits AS (
    SELECT d.donor_employer, k.industry, k.industry_group, k.keyword,
        row_number() OVER (PARTITION BY d.donor_employer ORDER BY k.priority, k.keyword) AS rk
    FROM (SELECT DISTINCT donor_employer FROM donor_pool) d
    JOIN kw k ON contains(lower(d.donor_employer), lower(k.keyword))
),
donor_ind AS (
    SELECT d.transaction_id, d.committee_id, d.amount, d.transaction_date, d.donor_employer,
        coalesce(h.industry, 'Unknown / Unclassified') AS industry,
        coalesce(h.industry_group, 'Unknown') AS industry_group,
        h.keyword AS matched_keyword,
        CASE WHEN h.industry IS NULL THEN 'unclassified' ELSE 'employer_keyword' END
            AS match_source
    FROM donor_pool d LEFT JOIN donor_hits h ON h.donor_employer = d.donor_employer AND h.rk = 1
),
flow AS (
    SELECT p.transaction_id, p.candidate_id, p.contributor_committee_id AS source_committee_id,
        CAST(NULL AS VARCHAR) AS donor_name, CAST(NULL AS VARCHAR) AS donor_employer,
        CAST(NULL AS VARCHAR) AS donor_occupation, p.amount, p.transaction_date,
        p.election_type, 'pac_direct' AS contribution_path, t.industry, t.industry_group,
        t.match_source, t.is_dark_money_suspect, coalesce(t.is_super_pac, false) AS is_super_pac
    FROM s_pac p LEFT JOIN tags t ON t.committee_id = p.contributor_committee_id
    WHERE NOT p.is_refund
    UNION ALL
    SELECT i.transaction_id, l.candidate_id, i.committee_id, i.donor_name, i.donor_employer,
        i.donor_occupation, i.amount, i.transaction_date, i.election_type, 'individual',
        coalesce(d.industry, 'Unknown / Unclassified'), coalesce(d.industry_group, 'Unknown'),
        CASE WHEN d.industry IS NULL THEN 'unclassified' ELSE 'employer_keyword' END, false, false
    FROM s_indiv i
    JOIN s_link l ON l.committee_id = i.committee_id
    LEFT JOIN donor_hits d ON d.donor_employer = i.donor_employer AND d.rk = 1
    WHERE i.is_individual_donor AND NOT i.is_refund
),
fund_agg AS (
    SELECT f.candidate_id,
        coalesce(c.candidate_name, f.candidate_id) AS candidate_name,
        coalesce(c.party_name, 'Unknown') AS party_name,
        coalesce(c.office, 'Unknown') AS office,
        coalesce(c.office_state, 'Unknown') AS office_state,
        c.election_year,
        coalesce(c.incumbent_challenger_status, 'Unknown') AS incumbent_challenger_status,
        c.cand_id IS NOT NULL AS has_candidate_profile,
        count(*) AS total_transactions,
        sum(f.amount) AS total_raised,
        coalesce(sum(f.amount) FILTER (WHERE f.contribution_path = 'pac_direct'), 0)
            AS raised_from_pacs,
        coalesce(sum(f.amount) FILTER (WHERE f.contribution_path = 'individual'), 0)
            AS raised_from_individuals,
        {ind_sums},
        coalesce(sum(f.amount) FILTER (WHERE f.is_dark_money_suspect), 0) AS raised_from_dark_money,
        coalesce(sum(f.amount) FILTER (WHERE f.is_super_pac), 0) AS raised_from_super_pacs,
        {src_sums},
        count(DISTINCT f.donor_name) FILTER (WHERE f.contribution_path = 'individual')
            AS unique_donor_count,
        percentile_cont(0.5) WITHIN GROUP (ORDER BY CASE WHEN f.contribution_path = 'individual'
                                           THEN f.amount END) AS median_individual_donation,
        coalesce(sum(f.amount) FILTER (WHERE f.contribution_path = 'individual'
                                       AND f.amount >= 1000), 0) AS large_individual,
        sum(f.amount) FILTER (WHERE f.contribution_path = 'individual') AS individual_total
    FROM flow f LEFT JOIN s_cand c ON c.cand_id = f.candidate_id
    GROUP BY ALL
),
funding AS (
    SELECT a.candidate_id, a.candidate_name, a.party_name, a.office, a.office_state,
        a.election_year, a.incumbent_challenger_status, a.has_candidate_profile,
        a.total_transactions, a.total_raised,
        s.tot_rec AS total_receipts_reported, s.ind_con AS ind_total_reported,
        {_pct('a.total_raised', 's.tot_rec')} AS pct_coverage,
        s.coverage_end_date AS financial_report_thru,
        a.raised_from_pacs, a.raised_from_individuals,
        {', '.join('a.' + c for c, _ in M.INDUSTRY_COLUMNS)},
        a.raised_from_dark_money, a.raised_from_super_pacs,
        {', '.join('a.' + c for c, _ in M.MATCH_SOURCE_COLUMNS)},
        {_pct('a.total_raised - a.unclassified_amount', 'a.total_raised')} AS pct_classified,
        a.unique_donor_count, a.median_individual_donation,
        {_pct('a.large_individual', 'a.individual_total')} AS pct_individual_from_large,
        {_pct('a.raised_from_pacs', 'coalesce(s.tot_rec, a.total_raised)')} AS pct_from_pacs,
        {_pct('a.raised_from_individuals', 'coalesce(s.tot_rec, a.total_raised)')}
            AS pct_from_individuals,
        {_pct('a.raised_from_dark_money', 'coalesce(s.tot_rec, a.total_raised)')} AS pct_dark_money,
        {_pct('a.raised_from_super_pacs', 'coalesce(s.tot_rec, a.total_raised)')} AS pct_super_pac
    FROM fund_agg a
    LEFT JOIN s_fin s ON s.cand_id = a.candidate_id AND s.fec_election_yr = a.election_year
),
large_totals AS (
    SELECT l.candidate_id, sum(i.amount) FILTER (WHERE i.amount >= 1000) AS large_donor_total
    FROM s_indiv i JOIN s_link l ON l.committee_id = i.committee_id
    WHERE i.is_individual_donor AND NOT i.is_refund
    GROUP BY l.candidate_id
),
parts AS (
    SELECT f.candidate_id, f.candidate_name, f.party_name, f.office, f.office_state,
        f.election_year, f.incumbent_challenger_status, f.total_raised, f.pct_from_pacs,
        f.pct_from_individuals, f.pct_dark_money, f.pct_super_pac, f.unique_donor_count,
        round(coalesce(f.median_individual_donation, 0), 2) AS median_individual_donation,
        coalesce(f.pct_individual_from_large, 100) AS pct_individual_from_large,
        {_pct('coalesce(g.large_donor_total, 0)', 'f.total_raised')} AS pct_large_donors,
        {_pct(top_ind, 'f.total_raised')} AS pct_top_industry,
        least(f.pct_from_pacs * {M.PAC_WEIGHT}, {M.PAC_CAP}) AS penalty_pac_concentration,
        least(f.pct_dark_money * {M.DARK_WEIGHT}, {M.DARK_CAP}) AS penalty_dark_money,
        least(f.pct_super_pac * {M.SUPER_PAC_WEIGHT}, {M.SUPER_PAC_CAP}) AS penalty_super_pac,
        least({_pct('coalesce(g.large_donor_total, 0)', 'f.total_raised')} * {M.LARGE_WEIGHT},
              {M.LARGE_CAP}) AS penalty_large_donors,
        least({top_ind} / nullif(f.total_raised, 0) * 100 * {M.INDUSTRY_WEIGHT},
              {M.INDUSTRY_CAP}) AS penalty_industry_capture,
        least(f.pct_from_individuals * {M.INDIVIDUAL_BONUS_WEIGHT}
              * greatest(0, 1.0 - coalesce(f.pct_individual_from_large, 100) / 100.0),
              {M.INDIVIDUAL_BONUS_CAP}) AS bonus_individual_pct,
        greatest(0, least(
            (1000.0 - least(coalesce(f.median_individual_donation, 1000), 1000)) / 1000.0 * 5
            + (1.0 - least(coalesce(f.pct_individual_from_large, 100), 100) / 100.0) * 5,
            10)) AS bonus_donor_distribution
    FROM funding f LEFT JOIN large_totals g ON g.candidate_id = f.candidate_id
),
scored AS (
    SELECT *, greatest(0, least(round(penalty_pac_concentration + penalty_dark_money
              + penalty_super_pac + penalty_large_donors + penalty_industry_capture
              - bonus_individual_pct - bonus_donor_distribution, 1), 100)) AS corruption_score
    FROM parts
),
score AS (
    SELECT *,
        round(percent_rank() OVER (PARTITION BY election_year, office
                                   ORDER BY corruption_score) * 100, 1) AS score_pct_within_office,
        ntile(10) OVER (PARTITION BY election_year, office
                        ORDER BY corruption_score, candidate_id) AS score_decile_within_office,
        round(percent_rank() OVER (ORDER BY corruption_score) * 100, 1) AS score_pct_overall,
        CASE WHEN corruption_score >= {M.HIGH_RISK_FROM} THEN 'High Risk'
             WHEN corruption_score >= {M.MODERATE_RISK_FROM} THEN 'Moderate Risk'
             ELSE 'Lower Risk' END AS risk_tier
    FROM scored
)"""


def with_models(select: str, by_cycle: bool = False) -> str:
    """Full oracle statement: the model CTE chain followed by ``select``."""
    chain = _by_cycle(ctes()) if by_cycle else ctes()
    return "WITH " + chain.strip() + "\n" + select
