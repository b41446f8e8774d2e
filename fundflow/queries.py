"""Registered queries: name -> Spark builder and name -> DuckDB oracle SQL.

Every builder takes ``(spark, sf_dir)``, reads the benchmark tables under
``sf_dir`` through the lens and returns a lazy DataFrame over the whole data.
Column names match the oracle's exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.numeric import MONEY_SUM
from .functions.text import (candidate_display_name, candidate_first_name,
                             candidate_last_name, normalize_employer, normalize_name)
from .oracle import sql as O
from .plans import catalog, filing_loads, marts, quality, report_sql, reports, staging, tagging
from .operators.keyword_match import first_match_join
from .operators.ranking import percent_rank_distributed
from .plans.pipeline import Models, warehouse_folder
from .plans.quality import NOT_NULL_CHECKS, UNIQUE_CHECKS, UNKNOWN_FLAG_CHECKS
from .sources import delimited, lens
from .sources.layouts import FILE_TYPES, columns_of

PROFILE_NAME = "household"          # name search used by the candidate pages
TOP_INDUSTRY = "Pharma & Healthcare"
HIST_WIDTH = 5.0

Builder = Callable[[SparkSession, str], DataFrame]


_MODELS: dict[tuple, Models] = {}


def _m(spark: SparkSession, sf_dir: str) -> Models:
    """Models over ``sf_dir`` with its table layer materialised once per application.

    Like the model build of the source pipeline, tags, flow and marts are
    written once (under ``spark.checkpoint.dir``), each by the first query that reads it;
    staging models stay lazy views over the raw tables, which are written likewise.
    """
    folder = warehouse_folder(spark, sf_dir)   # names the version of the input files
    key = (spark.sparkContext.applicationId, folder)
    if key not in _MODELS:
        models = Models.from_lens(spark, sf_dir)
        models.warehouse = folder
        _MODELS[key] = models
    return _MODELS[key]


# --- Spark builders ---------------------------------------------------------

def _normalize_text(spark, sf):
    raw = _m(spark, sf).raw_table
    ind, cm, cn = raw("individual_contributions"), raw("committees"), raw("candidates")
    parts = [
        ind.select(F.lit("employer").alias("kind"), F.col("employer").alias("raw_text"),
                   normalize_employer("employer").alias("normalized")),
        ind.select(F.lit("occupation"), "occupation", normalize_name("occupation")),
        cm.select(F.lit("organization"), "connected_org_nm", normalize_employer("connected_org_nm")),
        cm.select(F.lit("committee"), "cmte_nm", normalize_name("cmte_nm")),
        cn.select(F.lit("candidate"), "cand_name", candidate_display_name("cand_name")),
        cn.select(F.lit("candidate_last"), "cand_name", candidate_last_name("cand_name")),
        cn.select(F.lit("candidate_first"), "cand_name", candidate_first_name("cand_name")),
    ]
    # branches differ in ``kind``: one DISTINCT over the union (one shuffle)
    # equals the union of per-branch DISTINCTs
    parts = [p.toDF("kind", "raw_text", "normalized") for p in parts]
    return reduce(DataFrame.unionByName, parts).distinct()


def _size_buckets(spark, sf):
    return _m(spark, sf).individual.groupBy("donation_size_bucket").agg(
        F.count(F.lit(1)).alias("donations"), F.sum("amount").cast(MONEY_SUM).alias("total_amount"))


def _refund_flags(spark, sf):
    m = _m(spark, sf)
    rows = (m.individual.select(F.lit("individual").alias("source"), "is_refund", "amount")
            .unionByName(m.pac.select(F.lit("pac").alias("source"), "is_refund", "amount")))
    return rows.groupBy("source", "is_refund").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("total_amount"))


def _crosswalk_layer(spark, sf):
    m = _m(spark, sf)
    return tagging.crosswalk_matches(m.committees, m.raw_table("opensecrets_committees"),
                                     m.categories).drop("match_source")


def _keyword_layer(spark, sf):
    m = _m(spark, sf)
    return tagging.keyword_matches(m.committees, m.taxonomy, m.keywords).drop("match_source")


def _keyword_match_join(spark, sf):
    """The donor-industry table by the n-gram join plan, which has no bound on the taxonomy."""
    m = _m(spark, sf)
    donations = m.individual.filter(F.col("is_individual_donor") & ~F.col("is_refund"))
    tagged = first_match_join(donations, ["donor_employer"], m.taxonomy, "m")
    return tagging.individual_donor_industry(m.individual, m.taxonomy, m.keywords, tagged)


def _rejected_rows(spark, sf):
    """Rows and rejected lines per file, from raw rows written out as delimited lines."""
    columns = FILE_TYPES["pas2"][1]
    lines = spark.sql(lens.delimited_lines_sql("spark", columns),
                      raw=_m(spark, sf).sources["pac_contributions"])
    return delimited.line_counts(lines, columns)


def _filing_loads(spark, sf):
    return filing_loads.loaded_pac(spark, _m(spark, sf).sources[filing_loads.PAC], warehouse_folder(spark, sf))


def _file_manifest(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    files = spark.sql(lens.listing_sql(), part=part)
    return delimited.manifest_status(files, spark.sql(lens.manifest_sql(), part=part))


def _by_path(spark, sf):
    return _m(spark, sf).flow.groupBy("contribution_path", "match_source").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("total_amount"))


def _missing_committee(spark, sf):
    f = _m(spark, sf).flow
    return (f.filter((F.col("contribution_path") == "pac_direct") & F.col("match_source").isNull())
            .groupBy("source_committee_id").agg(
                F.count(F.lit(1)).alias("transactions"),
                F.sum("amount").cast(MONEY_SUM).alias("total_amount")))


def _funding_by_industry(spark, sf):
    return _m(spark, sf).flow.groupBy("candidate_id", "industry_group").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY_SUM).alias("total_amount"))


def _large_donor_totals(spark, sf):
    m = _m(spark, sf)
    return marts.large_donor_totals(m.individual, m.linkage)


def _donation_percent_rank(spark, sf):
    # three narrow passes over the source cost less than writing the raw table
    rows = staging.stg_individual_contributions(_m(spark, sf).sources["individual_contributions"]) \
        .select("transaction_id", "committee_id", "amount")
    return percent_rank_distributed(percent_rank_distributed(rows, [], "amount", "pct_overall"),
                                    ["committee_id"], "amount", "pct_in_committee")


def _published(spark, sf, names: set[str]) -> str:
    """The input's own schema names, the ``names`` in them published; their common suffix."""
    m = _m(spark, sf)
    suffix = "_" + m.warehouse.rstrip("/").rpartition("/")[2]
    missing = {n for n in names if not spark.catalog.tableExists(n.replace(".", f"{suffix}.", 1))}
    if missing:
        catalog.publish(m, {layer: layer + suffix for layer in ("raw", *catalog.LAYERS)}, missing)
    return suffix


def _sql_report(report, **parameters):
    def run(spark, sf):
        text = report_sql.REPORTS[report]
        suffix = _published(spark, sf, catalog.named_in(text))
        for layer in catalog.LAYERS:
            text = text.replace(f"{layer}.", f"{layer}{suffix}.")
        return catalog.run_report(spark, text, **parameters)
    return run


def _score_components(spark, sf):
    comp = marts.score_components(_m(spark, sf).funding_extras)
    return comp.drop("risk_tier")


def _risk_tiers(spark, sf):
    return _m(spark, sf).score.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("candidates"),
        F.min("corruption_score").alias("min_score"),
        F.max("corruption_score").alias("max_score"))


def _dq_duplicates(spark, sf):
    return quality.duplicate_keys(_m(spark, sf).sources["pac_contributions"], "sub_id")


def _queries() -> dict[str, tuple[Builder, str | None]]:
    m = _m
    q: dict[str, tuple[Builder, str | None]] = {}

    def reg(name: str, builder: Builder, oracle_select: str | None):
        q[name] = (builder, oracle_select)

    # step 1: staging and scalar functions
    reg("stg_candidates", lambda s, d: m(s, d).candidates, "SELECT * FROM s_cand")
    reg("stg_committees", lambda s, d: m(s, d).committees, "SELECT * FROM s_cmte")
    reg("stg_individual", lambda s, d: m(s, d).individual, "SELECT * FROM s_indiv")
    reg("stg_pac", lambda s, d: m(s, d).pac, "SELECT * FROM s_pac")
    reg("stg_linkage", lambda s, d: m(s, d).linkage, "SELECT * FROM s_link")
    reg("stg_financials", lambda s, d: m(s, d).financials, "SELECT * FROM s_fin")
    reg("normalize_text", _normalize_text, f"""
        SELECT DISTINCT 'employer' AS kind, employer AS raw_text, {O.emp('employer')} AS normalized
        FROM r_indiv
        UNION ALL SELECT DISTINCT 'occupation', occupation, {O.tc('occupation')} FROM r_indiv
        UNION ALL SELECT DISTINCT 'organization', connected_org_nm, {O.emp('connected_org_nm')}
        FROM r_cmte
        UNION ALL SELECT DISTINCT 'committee', cmte_nm, {O.tc('cmte_nm')} FROM r_cmte
        UNION ALL SELECT DISTINCT 'candidate', cand_name, {O.display_name('cand_name')} FROM r_cand
        UNION ALL SELECT DISTINCT 'candidate_last', cand_name, {O.last_name('cand_name')} FROM r_cand
        UNION ALL SELECT DISTINCT 'candidate_first', cand_name, {O.first_name('cand_name')}
        FROM r_cand""")
    reg("size_buckets", _size_buckets, """
        SELECT donation_size_bucket, count(*) AS donations, sum(amount) AS total_amount
        FROM s_indiv GROUP BY donation_size_bucket""")
    reg("refund_flags", _refund_flags, """
        SELECT 'individual' AS source, is_refund, count(*) AS transactions,
               sum(amount) AS total_amount FROM s_indiv GROUP BY is_refund
        UNION ALL
        SELECT 'pac', is_refund, count(*), sum(amount) FROM s_pac GROUP BY is_refund""")

    # step 2: tagging
    reg("committee_tags", lambda s, d: m(s, d).committee_tags, "SELECT * FROM tags")
    reg("committee_tags_crosswalk", _crosswalk_layer,
        "SELECT committee_id, industry, industry_group FROM xw_best")
    reg("committee_tags_keyword", _keyword_layer,
        "SELECT committee_id, industry, industry_group FROM kw_best")
    reg("donor_industry", lambda s, d: m(s, d).donor_industry, "SELECT * FROM donor_ind")
    reg("keyword_match_join", _keyword_match_join, "SELECT * FROM donor_ind")
    reg("dark_money_suspects", lambda s, d: tagging.dark_money_suspects(m(s, d).committee_tags),
        """SELECT committee_id, committee_name, connected_organization_name, organization_type,
                  committee_type FROM tags WHERE is_dark_money_suspect""")

    # step 3: money flow
    reg("money_flow", lambda s, d: m(s, d).flow, "SELECT * FROM flow")
    reg("money_flow_by_path", _by_path, """
        SELECT contribution_path, match_source, count(*) AS transactions,
               sum(amount) AS total_amount FROM flow GROUP BY ALL""")
    reg("flow_missing_committee", _missing_committee, """
        SELECT source_committee_id, count(*) AS transactions, sum(amount) AS total_amount
        FROM flow WHERE contribution_path = 'pac_direct' AND match_source IS NULL
        GROUP BY source_committee_id""")

    # step 4: funding mart
    reg("funding_summary", lambda s, d: m(s, d).funding, "SELECT * FROM funding")
    reg("funding_by_industry", _funding_by_industry, """
        SELECT candidate_id, industry_group, count(*) AS transactions, sum(amount) AS total_amount
        FROM flow GROUP BY ALL""")
    reg("funding_match_source", lambda s, d: m(s, d).funding.select(
            "candidate_id", *[c for c, _ in marts.MATCH_SOURCE_COLUMNS], "pct_classified"),
        f"""SELECT candidate_id, {', '.join(c for c, _ in marts.MATCH_SOURCE_COLUMNS)},
                   pct_classified FROM funding""")
    reg("donor_median", lambda s, d: m(s, d).funding.select(
            "candidate_id", "unique_donor_count", "median_individual_donation",
            "pct_individual_from_large"),
        """SELECT candidate_id, unique_donor_count, median_individual_donation,
                  pct_individual_from_large FROM funding""")
    reg("funding_vs_reported", lambda s, d: m(s, d).funding.select(
            "candidate_id", "election_year", "total_raised", "total_receipts_reported",
            "ind_total_reported", "pct_coverage", "financial_report_thru"),
        """SELECT candidate_id, election_year, total_raised, total_receipts_reported,
                  ind_total_reported, pct_coverage, financial_report_thru FROM funding""")

    # step 5: score mart
    reg("large_donor_totals", _large_donor_totals, """
        SELECT l.candidate_id,
               coalesce(sum(i.amount) FILTER (WHERE i.amount >= 1000), 0) AS large_donor_total,
               sum(i.amount) AS individual_total
        FROM s_indiv i JOIN s_link l ON l.committee_id = i.committee_id
        WHERE i.is_individual_donor AND NOT i.is_refund GROUP BY l.candidate_id""")
    reg("score_components", _score_components, "SELECT * FROM scored")
    reg("capture_score", lambda s, d: m(s, d).score, "SELECT * FROM score")
    reg("score_rank_office", lambda s, d: m(s, d).score.select(
            "candidate_id", "election_year", "office", "corruption_score",
            "score_pct_within_office", "score_decile_within_office"),
        """SELECT candidate_id, election_year, office, corruption_score, score_pct_within_office,
                  score_decile_within_office FROM score""")
    reg("score_rank_overall", lambda s, d: m(s, d).score.select(
            "candidate_id", "corruption_score", "score_pct_overall"),
        "SELECT candidate_id, corruption_score, score_pct_overall FROM score")
    reg("risk_tiers", _risk_tiers, """
        SELECT risk_tier, count(*) AS candidates, min(corruption_score) AS min_score,
               max(corruption_score) AS max_score FROM score GROUP BY risk_tier""")

    # per-cycle grain
    reg("funding_summary_by_cycle", lambda s, d: m(s, d).funding_by_cycle.drop("large_donor_total"),
        "SELECT * FROM funding_cycle")
    reg("capture_score_by_cycle", lambda s, d: m(s, d).score_by_cycle, "SELECT * FROM score_cycle")
    reg("donation_percent_rank", _donation_percent_rank, """
        SELECT transaction_id, committee_id, amount, percent_rank() OVER (ORDER BY amount) AS pct_overall,
               percent_rank() OVER (PARTITION BY committee_id ORDER BY amount) AS pct_in_committee
        FROM s_indiv""")

    # step 6: reports
    def avg1(c):
        return f"CAST(sum(CAST({c} AS DECIMAL(20,1))) AS DOUBLE) / nullif(count({c}), 0)"

    def avg2(c):
        return f"CAST(sum(CAST({c} AS DECIMAL(20,2))) AS DOUBLE) / nullif(count({c}), 0)"

    def one_candidate(cols="*"):
        return (f"(SELECT {cols} FROM score WHERE candidate_name ILIKE '%{PROFILE_NAME}%' "
                f"ORDER BY election_year DESC NULLS LAST, candidate_id LIMIT 1)")

    reg("overview", lambda s, d: reports.overview(m(s, d).score), f"""
        SELECT count(DISTINCT candidate_id) AS total_candidates,
               count(DISTINCT election_year) AS cycles_covered,
               sum(total_raised) AS total_money,
               {avg1('corruption_score')} AS avg_corruption_score FROM score""")
    reg("top_captured", lambda s, d: reports.top_captured(m(s, d).score), f"""
        SELECT {', '.join(reports.TOP_COLUMNS)} FROM score
        ORDER BY corruption_score DESC, candidate_id LIMIT 20""")
    reg("party_totals", lambda s, d: reports.party_totals(m(s, d).score), f"""
        SELECT party_name, count(DISTINCT candidate_id) AS candidates,
               sum(total_raised) AS total_raised, {avg1('corruption_score')} AS avg_score,
               {avg2('pct_from_pacs')} AS avg_pct_pacs,
               {avg2('pct_dark_money')} AS avg_pct_dark_money
        FROM score WHERE party_name IN ('Democrat', 'Republican') GROUP BY party_name""")
    reg("tier_by_office", lambda s, d: reports.tier_by_office(m(s, d).score), """
        SELECT risk_tier, office, count(*) AS candidates FROM score GROUP BY ALL""")
    reg("leaderboard", lambda s, d: reports.leaderboard(m(s, d).score), f"""
        SELECT {', '.join(reports.LEADERBOARD_COLUMNS)} FROM score
        WHERE office LIKE '%' AND party_name LIKE '%' AND CAST(election_year AS VARCHAR) LIKE '%'
        ORDER BY corruption_score DESC, candidate_id LIMIT 100""")
    reg("leaderboard_house_democrat",
        lambda s, d: reports.leaderboard(m(s, d).score, "House", "Democrat", "%"), f"""
        SELECT {', '.join(reports.LEADERBOARD_COLUMNS)} FROM score
        WHERE office LIKE 'House' AND party_name LIKE 'Democrat'
          AND CAST(election_year AS VARCHAR) LIKE '%'
        ORDER BY corruption_score DESC, candidate_id LIMIT 100""")
    reg("leaderboard_1998_senate",
        lambda s, d: reports.leaderboard(m(s, d).score, "Senate", "%", "1998"), f"""
        SELECT {', '.join(reports.LEADERBOARD_COLUMNS)} FROM score
        WHERE office LIKE 'Senate' AND party_name LIKE '%'
          AND CAST(election_year AS VARCHAR) LIKE '1998'
        ORDER BY corruption_score DESC, candidate_id LIMIT 100""")
    reg("score_histogram", lambda s, d: reports.score_histogram(m(s, d).score, width=HIST_WIDTH),
        f"""SELECT CAST(floor(corruption_score / {HIST_WIDTH}) AS BIGINT) AS bin, party_name,
                   count(*) AS candidates,
                   CAST(floor(corruption_score / {HIST_WIDTH}) AS BIGINT) * CAST({HIST_WIDTH} AS DOUBLE)
                     AS bin_start
            FROM score WHERE office LIKE '%' AND party_name LIKE '%' GROUP BY ALL""")
    reg("industry_totals", lambda s, d: reports.industry_totals(
            m(s, d).pair_sums, m(s, d).committee_tags, m(s, d).score), f"""
        SELECT t.industry_group, count(DISTINCT f.candidate_id) AS candidates_funded,
               sum(f.amount) AS total_contributed, {avg1('s.corruption_score')} AS avg_candidate_score
        FROM flow f JOIN tags t ON f.source_committee_id = t.committee_id
        JOIN score s ON f.candidate_id = s.candidate_id
        WHERE t.industry_group <> 'Unknown / Unclassified' GROUP BY t.industry_group""")
    reg("industry_by_party", lambda s, d: reports.industry_by_party(
            m(s, d).pair_sums, m(s, d).committee_tags, m(s, d).candidates), """
        SELECT t.industry_group, c.party_name, sum(f.amount) AS total
        FROM flow f JOIN tags t ON f.source_committee_id = t.committee_id
        JOIN s_cand c ON f.candidate_id = c.cand_id
        WHERE t.industry_group <> 'Unknown / Unclassified'
          AND c.party_name IN ('Democrat', 'Republican')
        GROUP BY t.industry_group, c.party_name""")
    reg("top_recipients", lambda s, d: reports.top_recipients(
            m(s, d).pair_sums, m(s, d).committee_tags, m(s, d).candidates, m(s, d).score,
            TOP_INDUSTRY), f"""
        SELECT c.candidate_name, c.party_name, c.office, c.office_state, c.election_year,
               sum(f.amount) AS received, s.corruption_score, s.risk_tier
        FROM flow f JOIN tags t ON f.source_committee_id = t.committee_id
        JOIN s_cand c ON f.candidate_id = c.cand_id
        JOIN score s ON f.candidate_id = s.candidate_id
        WHERE t.industry_group = '{TOP_INDUSTRY}'
        GROUP BY c.candidate_name, c.party_name, c.office, c.office_state, c.election_year,
                 s.corruption_score, s.risk_tier
        ORDER BY received DESC, candidate_name NULLS LAST, party_name NULLS LAST,
                 office NULLS LAST, office_state NULLS LAST, election_year NULLS LAST,
                 corruption_score NULLS LAST, risk_tier NULLS LAST
        LIMIT 25""")
    reg("dark_overview", lambda s, d: reports.dark_overview(
            m(s, d).committee_tags, m(s, d).funding, m(s, d).score), f"""
        SELECT (SELECT count(DISTINCT committee_id) FROM tags WHERE is_dark_money_suspect)
                 AS dark_money_pacs,
               (SELECT sum(raised_from_dark_money) FROM funding) AS total_dark_money,
               (SELECT {avg2('pct_dark_money')} FROM score) AS avg_pct_dark_money""")
    reg("dark_overview_literal", lambda s, d: reports.dark_overview_literal(
            m(s, d).committee_tags, m(s, d).funding, m(s, d).score), f"""
        SELECT count(DISTINCT ct.committee_id) AS dark_money_pacs,
               sum(f.raised_from_dark_money) AS total_dark_money,
               {avg2('s.pct_dark_money')} AS avg_pct_dark_money
        FROM tags ct JOIN funding f ON 1 = 1 JOIN score s USING (candidate_id)
        WHERE ct.is_dark_money_suspect""")
    reg("dark_committees", lambda s, d: reports.dark_committees(
            m(s, d).committee_tags, m(s, d).pair_sums), """
        SELECT ct.committee_name, ct.connected_organization_name, ct.organization_type,
               count(DISTINCT c.candidate_id) AS candidates_funded, sum(c.amount) AS total_spent
        FROM tags ct JOIN flow c ON ct.committee_id = c.source_committee_id
        WHERE ct.is_dark_money_suspect GROUP BY ALL
        ORDER BY total_spent DESC, committee_name NULLS LAST,
                 connected_organization_name NULLS LAST, organization_type NULLS LAST
        LIMIT 50""")
    reg("dark_candidates", lambda s, d: reports.dark_candidates(
            m(s, d).funding, m(s, d).score), f"""
        SELECT {', '.join('s.' + c if c != 'raised_from_dark_money' else 'f.' + c
                          for c in reports.DARK_CANDIDATE_COLUMNS)}
        FROM funding f JOIN score s USING (candidate_id)
        WHERE f.raised_from_dark_money > 0
        ORDER BY f.raised_from_dark_money DESC, candidate_id LIMIT 50""")
    reg("profile", lambda s, d: reports.profile(m(s, d).score, m(s, d).funding, PROFILE_NAME),
        f"""SELECT {', '.join('o.' + c for c in reports.PROFILE_COLUMNS)},
                   {', '.join('f.' + c for c in reports.INDUSTRY_FUNDING)}
            FROM {one_candidate()} o JOIN funding f ON f.candidate_id = o.candidate_id""")
    reg("funding_mix", lambda s, d: reports.funding_mix(m(s, d).score, PROFILE_NAME), f"""
        SELECT 'PACs' AS source, pct_from_pacs AS pct FROM {one_candidate()} o1
        UNION ALL SELECT 'Individuals', pct_from_individuals FROM {one_candidate()} o2
        UNION ALL SELECT 'Dark Money', pct_dark_money FROM {one_candidate()} o3""")
    reg("industry_breakdown", lambda s, d: reports.industry_breakdown(
            m(s, d).pair_sums, m(s, d).committee_tags, m(s, d).candidates, PROFILE_NAME), f"""
        SELECT ct.industry_group, sum(c.amount) AS total
        FROM flow c JOIN tags ct ON c.source_committee_id = ct.committee_id
        JOIN s_cand cand ON c.candidate_id = cand.cand_id
        WHERE cand.candidate_name ILIKE '%{PROFILE_NAME}%'
          AND ct.industry_group <> 'Unknown / Unclassified'
        GROUP BY ct.industry_group""")
    comp_union = " UNION ALL ".join(
        f"SELECT '{label}' AS component, {'-' if sign < 0 else ''}{col} AS value, '{kind}' AS type "
        f"FROM {one_candidate()} o{i}"
        for i, (label, col, sign, kind) in enumerate(reports.COMPONENTS))
    reg("component_breakdown", lambda s, d: reports.component_breakdown(
            m(s, d).score, PROFILE_NAME), comp_union)
    reg("top_senate", lambda s, d: reports.top_by_office(m(s, d).score, "Senate"), """
        SELECT candidate_name, party_name, office_state, total_raised, pct_from_pacs,
               corruption_score, risk_tier FROM score WHERE office = 'Senate'
        ORDER BY corruption_score DESC, candidate_id LIMIT 20""")

    # the reports as SQL text over published names
    for name, parameters in (("industry_totals", {}), ("top_recipients", {"industry": TOP_INDUSTRY}),
                             ("dark_committees", {}), ("leaderboard", {"office": "House", "party": "%", "year": "%"}),
                             ("profile", {"name": f"%{PROFILE_NAME}%"}), ("top_senate", {})):
        reg(f"sql_{name}", _sql_report(name, **parameters), report_sql.for_oracle(name, **parameters))

    # step 7: data quality and load accounting
    raw_alias = {"individual_contributions": "r_indiv", "pac_contributions": "r_pac",
                 "candidates": "r_cand", "committees": "r_cmte",
                 "candidate_committee_linkage": "r_link",
                 "candidate_financial_summary": "r_fin", "opensecrets_committees": "r_xwalk"}
    nn = [f"""SELECT 'not_null' AS check_name, '{t}' AS table_name, '{c}' AS column_name,
                     count(*) FILTER (WHERE {c} IS NULL) AS failing_rows,
                     count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM {raw_alias[t]}"""
          for t, c in NOT_NULL_CHECKS]
    uq = [f"""SELECT 'unique', '{t}', '{c}', count(*), count(*) = 0 FROM (
                SELECT {c}, cycle_year FROM {raw_alias[t]} WHERE {c} IS NOT NULL
                GROUP BY {c}, cycle_year HAVING count(*) > 1) d"""
          for t, c in UNIQUE_CHECKS]
    typed = {"transaction_tp": "CAST(transaction_amt AS DECIMAL(12,2)) >= 0",
             "entity_tp": "transaction_amt IS NOT NULL"}
    uf = [f"""SELECT 'flag_known', '{t}', '{c}', count(*), count(*) = 0
              FROM {raw_alias[t]} WHERE {c} IS NULL AND {typed[c]}"""
          for t, c in UNKNOWN_FLAG_CHECKS]
    reg("dq_checks", lambda s, d: quality.quality_report(m(s, d).raw),
        " UNION ALL ".join(nn + uq + uf))
    reg("rejected_rows", _rejected_rows, f"""
        SELECT cycle_year, source_file, count(*) FILTER (WHERE NOT ({lens.BAD_LINE})) AS rows,
               count(*) FILTER (WHERE {lens.BAD_LINE}) AS rejected
        FROM r_pac GROUP BY cycle_year, source_file""")
    fields = ", ".join(f"nullif({lens.FILING_NAME if c == 'name' else c}, '') AS {c}"
                       for c in columns_of(filing_loads.PAC))
    reg("filing_round_trip", lambda s, d: filing_loads.round_trip(s, _filing_loads(s, d)), f"""
        SELECT {fields}, cycle_year, {lens.FILING_FILE} AS source_file FROM r_pac
        WHERE NOT ({lens.BAD_LINE}) AND NOT ({lens.BAD_BYTES})""")
    reg("filing_quarantine", lambda s, d: filing_loads.set_aside(s, _filing_loads(s, d)), f"""
        SELECT cycle_year, {lens.FILING_FILE} AS source_file,
               CASE WHEN {lens.BAD_BYTES} THEN 'bytes' ELSE 'fields' END AS reason, count(*) AS n_lines
        FROM r_pac WHERE ({lens.BAD_LINE}) OR ({lens.BAD_BYTES}) GROUP BY ALL""")
    reg("filing_manifest", lambda s, d: filing_loads.load_record(s, _filing_loads(s, d)), f"""
        SELECT cycle_year, {lens.FILING_FILE} AS source_file, {lens.FILING_FILE} = 'quoted' AS quoted,
               count(*) FILTER (WHERE NOT ({lens.BAD_LINE}) AND NOT ({lens.BAD_BYTES})) AS rows,
               count(*) FILTER (WHERE ({lens.BAD_LINE}) OR ({lens.BAD_BYTES})) AS rejected
        FROM r_pac GROUP BY ALL""")
    states = "SELECT *, count(*) FILTER (WHERE NOT late) OVER f AS early, count(*) OVER f AS whole " \
             f"FROM ({lens.link_files_sql('r_link')}) WINDOW f AS (PARTITION BY cycle_year, source_file)"
    per_file = f"SELECT DISTINCT cycle_year, source_file, early, whole FROM ({states})"
    after = "CASE WHEN source_file IN ('f2', 'f4') THEN whole ELSE early END"
    reg("incremental_load", lambda s, d: filing_loads.incremental_runs(
            s, m(s, d).raw_table(filing_loads.LINK)), f"""
        SELECT 1 AS run, cycle_year, source_file AS file_name, 'new' AS status, early AS rows, early AS table_rows
        FROM ({per_file}) WHERE source_file <> 'f4' AND early > 0
        UNION ALL
        SELECT 2, cycle_year, source_file, CASE WHEN source_file = 'f4' OR early = 0 THEN 'new'
               WHEN {after} = early THEN 'skipped' ELSE 'changed' END, {after}, {after}
        FROM ({per_file}) WHERE {after} > 0
        UNION ALL
        SELECT 3, cycle_year, source_file, 'skipped', {after}, {after} FROM ({per_file}) WHERE {after} > 0""")
    reg("file_manifest", _file_manifest, f"""
        SELECT l.*, CASE
            WHEN NOT EXISTS (SELECT 1 FROM ({lens.manifest_sql('part')}) r WHERE r.cycle_year = l.cycle_year
                             AND r.file_type = l.file_type AND r.file_name = l.file_name) THEN 'new'
            WHEN l.file_size > 0 AND EXISTS (
                SELECT 1 FROM ({lens.manifest_sql('part')}) r WHERE r.cycle_year = l.cycle_year AND r.file_type = l.file_type
                AND r.file_name = l.file_name AND r.file_size = l.file_size) THEN 'skipped'
            ELSE 'changed' END AS status
        FROM ({lens.listing_sql('part')}) l""")
    reg("dq_duplicates", _dq_duplicates, """
        SELECT sub_id, cycle_year, count(*) AS n_records FROM r_pac WHERE sub_id IS NOT NULL
        GROUP BY sub_id, cycle_year HAVING count(*) > 1""")
    reg("load_counts", lambda s, d: quality.load_counts(m(s, d).raw), " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, cycle_year, source_file, count(*) AS rows FROM {a} "
        f"GROUP BY cycle_year, source_file" for t, a in raw_alias.items()))
    reg("load_total", lambda s, d: quality.load_total(m(s, d).raw), "SELECT CAST(sum(rows) AS BIGINT) AS total_rows, "
        "count(*) AS loads FROM (" + " UNION ALL ".join(
            f"SELECT cycle_year, source_file, count(*) AS rows FROM {a} GROUP BY cycle_year, source_file"
            for a in raw_alias.values()) + ") t")
    return q


REGISTRY = _queries()


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: O.with_models(v[1], by_cycle=k.endswith("_by_cycle")) for k, v in REGISTRY.items() if v[1] is not None}
