"""The report queries as SQL text over the published names (see ``catalog``).

Parameters are written ``:name`` and bound.  The texts run unchanged on Spark; the registered
queries run the same texts on DuckDB, with the names replaced by the oracle's own models.
Every ``LIMIT`` is a top-k report, its ties broken by the keys at the end of the ORDER BY.
"""

from __future__ import annotations

from . import reports

SCORE = "marts.mart_candidate_corruption_score"
FUNDING = "marts.mart_candidate_funding_summary"
FLOW = "intermediate.int_contributions_to_candidates"
TAGS = "intermediate.int_committee_industry_tags"
CANDIDATES = "staging.stg_candidates"


def _mean(column: str, scale: int) -> str:
    """The average of an already rounded column, from its exact sum."""
    return f"CAST(sum(CAST({column} AS DECIMAL(20,{scale}))) AS DOUBLE) / nullif(count({column}), 0)"


def _shown(names: list[str], alias: str = "") -> str:
    return ", ".join(alias + n for n in names)


def _chosen(columns: str) -> str:
    return f"""(SELECT {columns} FROM {SCORE} WHERE candidate_name ILIKE :name
      ORDER BY election_year DESC NULLS LAST, candidate_id LIMIT 1)"""


REPORTS: dict[str, str] = {
    "overview": f"""
      SELECT count(DISTINCT candidate_id) AS total_candidates, count(DISTINCT election_year) AS cycles_covered,
             sum(total_raised) AS total_money, {_mean('corruption_score', 1)} AS avg_corruption_score
      FROM {SCORE}""",
    "top_captured": f"""
      SELECT {_shown(reports.TOP_COLUMNS)} FROM {SCORE} ORDER BY corruption_score DESC, candidate_id LIMIT 20""",
    "party_totals": f"""
      SELECT party_name, count(DISTINCT candidate_id) AS candidates, sum(total_raised) AS total_raised,
             {_mean('corruption_score', 1)} AS avg_score, {_mean('pct_from_pacs', 2)} AS avg_pct_pacs,
             {_mean('pct_dark_money', 2)} AS avg_pct_dark_money
      FROM {SCORE} WHERE party_name IN ('Democrat', 'Republican') GROUP BY party_name""",
    "tier_by_office": f"SELECT risk_tier, office, count(*) AS candidates FROM {SCORE} GROUP BY risk_tier, office",
    "leaderboard": f"""
      SELECT {_shown(reports.LEADERBOARD_COLUMNS)} FROM {SCORE}
      WHERE office LIKE :office AND party_name LIKE :party AND CAST(election_year AS STRING) LIKE :year
      ORDER BY corruption_score DESC, candidate_id LIMIT 100""",
    "score_histogram": f"""
      SELECT CAST(floor(corruption_score / 5.0) AS BIGINT) AS bin, party_name, count(*) AS candidates,
             CAST(floor(corruption_score / 5.0) AS BIGINT) * CAST(5.0 AS DOUBLE) AS bin_start
      FROM {SCORE} WHERE office LIKE :office AND party_name LIKE :party
      GROUP BY CAST(floor(corruption_score / 5.0) AS BIGINT), party_name""",
    "industry_totals": f"""
      SELECT t.industry_group, count(DISTINCT f.candidate_id) AS candidates_funded, sum(f.amount) AS total_contributed,
             {_mean('s.corruption_score', 1)} AS avg_candidate_score
      FROM {FLOW} f JOIN {TAGS} t ON f.source_committee_id = t.committee_id
      JOIN {SCORE} s ON f.candidate_id = s.candidate_id
      WHERE t.industry_group <> 'Unknown / Unclassified' GROUP BY t.industry_group""",
    "industry_by_party": f"""
      SELECT t.industry_group, c.party_name, sum(f.amount) AS total
      FROM {FLOW} f JOIN {TAGS} t ON f.source_committee_id = t.committee_id
      JOIN {CANDIDATES} c ON f.candidate_id = c.cand_id
      WHERE t.industry_group <> 'Unknown / Unclassified' AND c.party_name IN ('Democrat', 'Republican')
      GROUP BY t.industry_group, c.party_name""",
    "top_recipients": f"""
      SELECT c.candidate_name, c.party_name, c.office, c.office_state, c.election_year, sum(f.amount) AS received,
             s.corruption_score, s.risk_tier
      FROM {FLOW} f JOIN {TAGS} t ON f.source_committee_id = t.committee_id
      JOIN {CANDIDATES} c ON f.candidate_id = c.cand_id JOIN {SCORE} s ON f.candidate_id = s.candidate_id
      WHERE t.industry_group = :industry
      GROUP BY c.candidate_name, c.party_name, c.office, c.office_state, c.election_year, s.corruption_score,
               s.risk_tier
      ORDER BY received DESC, candidate_name NULLS LAST, party_name NULLS LAST, office NULLS LAST,
               office_state NULLS LAST, election_year NULLS LAST, corruption_score NULLS LAST, risk_tier NULLS LAST
      LIMIT 25""",
    "dark_overview": f"""
      SELECT (SELECT count(DISTINCT committee_id) FROM {TAGS} WHERE is_dark_money_suspect) AS dark_money_pacs,
             (SELECT sum(raised_from_dark_money) FROM {FUNDING}) AS total_dark_money,
             (SELECT {_mean('pct_dark_money', 2)} FROM {SCORE}) AS avg_pct_dark_money""",
    "dark_committees": f"""
      SELECT t.committee_name, t.connected_organization_name, t.organization_type,
             count(DISTINCT f.candidate_id) AS candidates_funded, sum(f.amount) AS total_spent
      FROM {TAGS} t JOIN {FLOW} f ON t.committee_id = f.source_committee_id
      WHERE t.is_dark_money_suspect GROUP BY t.committee_name, t.connected_organization_name, t.organization_type
      ORDER BY total_spent DESC, committee_name NULLS LAST, connected_organization_name NULLS LAST,
               organization_type NULLS LAST
      LIMIT 50""",
    "dark_candidates": f"""
      SELECT {', '.join(('f.' if c == 'raised_from_dark_money' else 's.') + c for c in reports.DARK_CANDIDATE_COLUMNS)}
      FROM {FUNDING} f JOIN {SCORE} s ON f.candidate_id = s.candidate_id
      WHERE f.raised_from_dark_money > 0 ORDER BY f.raised_from_dark_money DESC, s.candidate_id LIMIT 50""",
    "profile": f"""
      SELECT {_shown(reports.PROFILE_COLUMNS, 'o.')}, {_shown(reports.INDUSTRY_FUNDING, 'f.')}
      FROM {_chosen('*')} o JOIN {FUNDING} f ON f.candidate_id = o.candidate_id""",
    "funding_mix": " UNION ALL ".join(
        f"SELECT '{label}' AS source, {column} AS pct FROM {_chosen(column)} o" for label, column in (
            ("PACs", "pct_from_pacs"), ("Individuals", "pct_from_individuals"), ("Dark Money", "pct_dark_money"))),
    "industry_breakdown": f"""
      SELECT t.industry_group, sum(f.amount) AS total
      FROM {FLOW} f JOIN {TAGS} t ON f.source_committee_id = t.committee_id
      JOIN {CANDIDATES} c ON f.candidate_id = c.cand_id
      WHERE c.candidate_name ILIKE :name AND t.industry_group <> 'Unknown / Unclassified' GROUP BY t.industry_group""",
    "component_breakdown": " UNION ALL ".join(
        f"SELECT '{label}' AS component, {'-' if sign < 0 else ''}{column} AS value, '{kind}' AS type "
        f"FROM {_chosen(column)} o" for label, column, sign, kind in reports.COMPONENTS),
    "top_senate": f"""
      SELECT candidate_name, party_name, office_state, total_raised, pct_from_pacs, corruption_score, risk_tier
      FROM {SCORE} WHERE office = 'Senate' ORDER BY corruption_score DESC, candidate_id LIMIT 20""",
}

# The oracle's own names for the published ones.
ORACLE_NAMES = {SCORE: "score", FUNDING: "funding", FLOW: "flow", TAGS: "tags", CANDIDATES: "s_cand"}


def for_oracle(report: str, **parameters: str) -> str:
    """A report's text for DuckDB: the oracle's names, parameters as literals."""
    text = REPORTS[report]
    for published, own in ORACLE_NAMES.items():
        text = text.replace(published, own)
    for key, value in parameters.items():
        text = text.replace(f":{key}", "'" + value.replace("'", "''") + "'")
    return text
