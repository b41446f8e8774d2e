"""Lens: campaign-shaped raw tables derived from the benchmark parquet.

The benchmark tables are TPC-H-like, not filings, so each raw table is a
deterministic projection of them: customers become candidates, parts become
committees, line items become committee-to-candidate transactions, events
become individual donations and suppliers become candidate/committee links.
Every raw column is text, exactly as the bulk loader would produce it.

The same SQL text runs on Spark (``spark.sql`` with DataFrame arguments) and
on DuckDB (the oracle), so both engines see identical raw rows.  Only the
date formatting call differs between the two dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import seeds

SOURCE_TABLES = ["customer", "nation", "part", "lineitem", "orders", "events", "supplier"]


def _id(prefix: str, expr: str) -> str:
    return f"('{prefix}' || lpad(cast({expr} as string), 8, '0'))"


def _seed_keyword(expr: str) -> str:
    """A keyword of the seed taxonomy, all of them in turn as ``expr`` counts up."""
    words = [r[0].replace("'", "''") for r in seeds.taxonomy_rows()]
    return f"split_part('{'|'.join(words)}', '|', cast({expr} % {len(words)} + 1 as int))"


def _mmddyyyy(expr: str, dialect: str) -> str:
    if dialect == "spark":
        return f"date_format({expr}, 'MMddyyyy')"
    return f"strftime({expr}, '%m%d%Y')"


def _candidates(t) -> str:
    base = f"""
      SELECT c.c_custkey AS k, c.c_nationkey AS nk, c.c_mktsegment AS seg, n.n_name AS nation
      FROM {t('customer')} c JOIN {t('nation')} n ON c.c_nationkey = n.n_nationkey"""

    def row(year_expr: str, name_prefix: str) -> str:
        return f"""
      SELECT
        CASE WHEN k % 50 = 49 THEN {_id('G', 'k')} ELSE {_id('H', 'k')} END AS cand_id,
        '{name_prefix}' || seg || ', ' || nation || ' ' || cast(k as string) AS cand_name,
        CASE k % 6 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' WHEN 2 THEN 'IND'
                   WHEN 3 THEN 'LIB' WHEN 4 THEN 'GRE' ELSE 'XXX' END AS cand_pty_affiliation,
        cast({year_expr} as string) AS cand_election_yr,
        nation AS cand_office_st,
        CASE WHEN k % 7 < 4 THEN 'H' WHEN k % 7 < 6 THEN 'S' ELSE 'P' END AS cand_office,
        lpad(cast(nk % 10 as string), 2, '0') AS cand_office_district,
        CASE k % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'C' WHEN 2 THEN 'O' ELSE NULL END AS cand_ici,
        CASE k % 5 WHEN 0 THEN 'C' WHEN 1 THEN 'F' WHEN 2 THEN 'N' WHEN 3 THEN 'P' ELSE 'X' END
          AS cand_status,
        {_id('S', 'k % 97')} AS cand_pcc,
        cast(k as string) || ' MAIN ST' AS cand_st1,
        CAST(NULL AS string) AS cand_st2,
        '  ' || lower(nation) || '   falls ' AS cand_city,
        'S' || lpad(cast(nk as string), 2, '0') AS cand_st,
        lpad(cast(k % 100000 as string), 5, '0') AS cand_zip,
        cast({year_expr} as int) AS cycle_year,
        'cn.txt' AS source_file
      FROM base"""

    return (f"WITH base AS ({base})"
            + row("1996 + 2 * (k % 3)", "")
            + " UNION ALL "
            + row("1992 + 2 * (k % 3)", "FORMER "))


def _committees(t) -> str:
    def row(year: int, name: str, where: str) -> str:
        return f"""
      SELECT
        {_id('C', 'p_partkey')} AS cmte_id,
        {name} AS cmte_nm,
        'TREASURER ' || cast(p_partkey % 50 as string) AS tres_nm,
        cast(p_partkey as string) || ' K ST NW' AS cmte_st1,
        CAST(NULL AS string) AS cmte_st2,
        lower(p_brand) AS cmte_city,
        'S' || lpad(cast(p_partkey % 50 as string), 2, '0') AS cmte_st,
        lpad(cast(p_partkey % 100000 as string), 5, '0') AS cmte_zip,
        CASE p_size % 6 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'D'
                        WHEN 3 THEN 'J' WHEN 4 THEN 'P' ELSE 'U' END AS cmte_dsgn,
        CASE p_size % 5 WHEN 0 THEN 'O' WHEN 1 THEN 'Q' WHEN 2 THEN 'N'
                        WHEN 3 THEN 'W' ELSE 'O' END AS cmte_tp,
        CASE p_partkey % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE NULL END AS cmte_pty_affiliation,
        CASE p_partkey % 4 WHEN 0 THEN 'Q' WHEN 1 THEN 'M' ELSE 'T' END AS cmte_filing_freq,
        CASE p_partkey % 7 WHEN 0 THEN 'C' WHEN 1 THEN 'L' WHEN 2 THEN 'M' WHEN 3 THEN 'T'
                           WHEN 4 THEN 'V' WHEN 5 THEN 'W' ELSE NULL END AS org_tp,
        CASE WHEN p_partkey % 7 = 0 THEN NULL
             ELSE p_type || ' & ' || p_brand || ' INC' END AS connected_org_nm,
        {_id('H', 'p_partkey')} AS cand_id,
        {year} AS cycle_year,
        'cm.txt' AS source_file
      FROM {t('part')}{where}"""

    # every fifth committee carries a seed keyword in its name, every tenth files in a second
    # cycle as well (its transactions then count once per cycle, as in the source)
    keyword = f"upper({_seed_keyword('p_partkey')})"
    name = f"CASE WHEN p_partkey % 5 = 1 THEN {keyword} || ' FUND' ELSE upper(p_name) END"
    return (row(2000, name, "") + " UNION ALL "
            + row(2002, "upper(p_name) || ' COMMITTEE'", " WHERE p_partkey % 10 = 3"))


def _pac(t, dialect: str) -> str:
    amount = ("cast(CASE WHEN l.l_linenumber = 6 AND l.l_quantity < 5 THEN -l.l_quantity "
              "ELSE l.l_quantity * 20 + l.l_linenumber END as decimal(12,2))")
    return f"""
      SELECT
        CASE WHEN l.l_linenumber = 5 AND l.l_quantity > 45 THEN {_id('U', 'l.l_partkey % 100')}
             ELSE {_id('C', 'l.l_partkey')} END AS cmte_id,
        CASE WHEN l.l_linenumber = 3 THEN 'A' ELSE 'N' END AS amndt_ind,
        'Q' || cast(l.l_linenumber % 4 + 1 as string) AS rpt_tp,
        CASE l.l_linestatus WHEN 'O' THEN 'P2024' ELSE 'G2024' END AS transaction_pgi,
        cast(l.l_orderkey as string) AS image_num,
        CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN '22Y'
             WHEN l.l_linenumber = 7 THEN NULL ELSE '24K' END AS transaction_tp,
        CASE l.l_suppkey % 3 WHEN 0 THEN 'PAC' WHEN 1 THEN 'ORG' ELSE 'CCM' END AS entity_tp,
        'SUPPLIER ' || cast(l.l_suppkey as string) AS name,
        'CITY ' || cast(l.l_suppkey % 20 as string) AS city,
        'S' || lpad(cast(l.l_suppkey % 50 as string), 2, '0') AS state,
        lpad(cast(l.l_suppkey % 100000 as string), 5, '0') AS zip_code,
        CAST(NULL AS string) AS employer,
        CAST(NULL AS string) AS occupation,
        CASE WHEN l.l_linenumber = 4 AND l.l_quantity > 48 THEN '1312024'
             ELSE {_mmddyyyy('l.l_shipdate', dialect)} END AS transaction_dt,
        cast({amount} as string) AS transaction_amt,
        {_id('S', 'l.l_suppkey')} AS other_id,
        {_id('H', 'o.o_custkey')} AS cand_id,
        'SB' || cast(l.l_orderkey as string) || '.' || cast(l.l_linenumber as string) AS tran_id,
        cast(o.o_orderkey % 9973 as string) AS file_num,
        CASE WHEN l.l_linenumber = 2 THEN 'X' ELSE NULL END AS memo_cd,
        CASE WHEN l.l_linenumber = 2 THEN 'EARMARKED' ELSE NULL END AS memo_text,
        'P' || cast(l.l_orderkey as string) || '_' || cast(l.l_linenumber as string) AS sub_id,
        cast(1996 + 2 * (o.o_custkey % 3) as int) AS cycle_year,
        'itpas2.txt' AS source_file
      FROM {t('lineitem')} l JOIN {t('orders')} o ON l.l_orderkey = o.o_orderkey"""


def _individual(t, dialect: str) -> str:
    amount = ("cast(CASE WHEN e.event_type = 'purchase' AND e.value < 5 THEN -e.value * 10 "
              "ELSE e.value * 10 END as decimal(12,2))")
    return f"""
      SELECT
        CASE WHEN e.event_id % 3 = 0 THEN {_id('S', '0')}
             ELSE {_id('S', 'e.event_id % 97')} END AS cmte_id,
        'N' AS amndt_ind,
        'M' || cast(e.event_id % 12 + 1 as string) AS rpt_tp,
        CASE e.event_id % 4 WHEN 0 THEN 'G2024' ELSE 'P2024' END AS transaction_pgi,
        cast(e.event_id as string) AS image_num,
        CASE e.event_type WHEN 'error' THEN '22Y' WHEN 'signup' THEN NULL ELSE '15' END
          AS transaction_tp,
        CASE e.event_type WHEN 'view' THEN 'ORG' ELSE 'IND' END AS entity_tp,
        'DONOR, USER ' || cast(e.user_id as string) AS name,
        'city ' || cast(e.user_id % 20 as string) AS city,
        'S' || lpad(cast(e.user_id % 50 as string), 2, '0') AS state,
        lpad(cast(e.user_id % 100000 as string), 5, '0') AS zip_code,
        CASE WHEN e.event_id % 11 = 0 THEN 'RETIRED'
             WHEN e.event_id % 13 = 0 THEN NULL
             WHEN e.event_id % 7 = 2 THEN upper({_seed_keyword('e.event_id')}) || ' INC'
             WHEN e.event_id % 17 = 0 THEN '  ' || upper(p.p_name) || ' &  SONS LLC.'
             ELSE upper(p.p_name) || ' INC' END AS employer,
        CASE e.user_id % 4 WHEN 0 THEN 'ENGINEER' WHEN 1 THEN 'TEACHER'
                           WHEN 2 THEN NULL ELSE '  sales   manager ' END AS occupation,
        {_mmddyyyy('e.ts', dialect)} AS transaction_dt,
        cast({amount} as string) AS transaction_amt,
        CASE WHEN e.event_id % 5 = 0 THEN {_id('C', 'e.event_id % 200')} ELSE NULL END AS other_id,
        'SA' || cast(e.event_id as string) AS tran_id,
        cast(e.event_id % 9973 as string) AS file_num,
        CAST(NULL AS string) AS memo_cd,
        CASE WHEN e.event_id % 5 = 0 THEN 'EARMARKED FOR ' || upper(p.p_brand) ELSE NULL END
          AS memo_text,
        cast(CASE WHEN e.event_id % 100 = 3 THEN e.event_id - 3 ELSE e.event_id END as string) AS sub_id,
        cast(1996 + 2 * (e.event_id % 3) as int) AS cycle_year,
        'itcont.txt' AS source_file
      FROM {t('events')} e JOIN {t('part')} p
        ON p.p_partkey = e.event_id % 200 AND p.p_partkey < 200"""


def _linkage(t) -> str:
    def link(cand_expr: str, year: str, suffix: str, linked: str) -> str:
        return f"""
      SELECT
        {_id('H', cand_expr)} AS cand_id,
        '{year}' AS cand_election_yr,
        '{year}' AS fec_election_yr,
        CASE WHEN {linked} THEN {_id('S', 's_suppkey')} END AS cmte_id,
        CASE s_suppkey % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'S' ELSE 'P' END AS cmte_tp,
        CASE s_suppkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'A' WHEN 2 THEN 'D' ELSE 'J' END AS cmte_dsgn,
        'L' || cast(s_suppkey as string) || '{suffix}' AS linkage_id,
        1996 AS cycle_year,
        'ccl.txt' AS source_file
      FROM {t('supplier')}"""

    # every supplier yields three link rows: its main link, a repeat of it in
    # 1998 and a second candidate; the last two name a committee only for
    # some suppliers (a link row without committee never joins)
    return (link("s_suppkey * 3", "1996", "", "true")
            + " UNION ALL " + link("s_suppkey * 3", "1998", "R", "s_suppkey % 10 = 0")
            + " UNION ALL " + link("s_suppkey * 3 + 1", "1996", "B", "s_suppkey % 10 = 5"))


def _financials(t) -> str:
    def money(expr: str, blank_when: str) -> str:
        return f"CASE WHEN {blank_when} THEN '' ELSE cast({expr} as string) END"

    year = "1996 + 2 * (c_custkey % 3)"
    return f"""
      SELECT
        CASE WHEN c_custkey % 9 = 0 THEN ' ' || {_id('H', 'c_custkey')} || ' '
             ELSE {_id('H', 'c_custkey')} END AS cand_id,
        upper(c_name) AS cand_name,
        CASE c_custkey % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'C' ELSE 'O' END AS cand_ici,
        cast(c_custkey % 3 + 1 as string) AS pty_cd,
        CASE c_custkey % 6 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE 'IND' END AS cand_pty_affiliation,
        {money('(c_custkey % 40) * 2500', 'c_custkey % 17 = 0')} AS ttl_receipts,
        '0' AS trans_from_auth,
        {money('(c_custkey % 40) * 2000', 'c_custkey % 19 = 0')} AS ttl_disb,
        '0' AS trans_to_auth,
        '0' AS coh_bop,
        cast(cast(c_acctbal as decimal(12,2)) as string) AS coh_cop,
        cast((c_custkey % 5) * 100 as string) AS cand_contrib,
        '0' AS cand_loans,
        '0' AS other_loans,
        '0' AS cand_loan_repay,
        '0' AS other_loan_repay,
        CASE WHEN c_custkey % 23 = 0 THEN '1,000' ELSE cast((c_custkey % 7) * 10 as string) END
          AS debts_owed_by,
        CASE WHEN c_custkey % 23 = 0 THEN '1,000'
             ELSE cast((c_custkey % 40) * 1000 as string) || '.50' END AS ttl_indiv_contrib,
        CAST(NULL AS string) AS cand_office_st,
        lpad(cast(c_nationkey % 10 as string), 2, '0') AS cand_office_district,
        CAST(NULL AS string) AS spec_election,
        CAST(NULL AS string) AS prim_election,
        CAST(NULL AS string) AS run_election,
        CASE WHEN c_custkey % 2 = 0 THEN 'W' ELSE 'L' END AS gen_election,
        cast(c_custkey % 100 as string) AS gen_election_precent,
        cast((c_custkey % 40) * 500 as string) AS other_pol_cmte_contrib,
        cast((c_custkey % 40) * 50 as string) AS pol_pty_contrib,
        CASE WHEN c_custkey % 11 = 0 THEN '02/30/' || cast({year} as string)
             WHEN c_custkey % 7 = 0 THEN ''
             WHEN c_custkey % 5 = 0 THEN '2/3/' || cast({year} as string)
             ELSE '12/31/' || cast({year} as string) END AS cvg_end_dt,
        cast((c_custkey % 10) * 10 as string) AS indiv_refunds,
        '0' AS cmte_refunds,
        cast(CASE WHEN c_custkey % 4 = 3 THEN {year} + 2 ELSE {year} END as int) AS cycle_year,
        'weball.txt' AS source_file
      FROM {t('customer')}"""


def _crosswalk(t) -> str:
    def xw(code: str, suffix: str) -> str:
        fec_id = (f"CASE WHEN p_partkey % 40 = 0 THEN ' ' || lower({_id('C', 'p_partkey')}) "
                  f"ELSE {_id('C', 'p_partkey')} END")
        return f"""
      SELECT
        '2000' AS cycle, {fec_id} AS fec_id,
        'PAC ' || cast(p_partkey as string) || '{suffix}' AS pac_short,
        upper(p_brand) AS affiliate, upper(p_brand) || ' HOLDINGS' AS ultorg,
        CAST(NULL AS string) AS recip_id, CAST(NULL AS string) AS recip_code,
        CAST(NULL AS string) AS fec_cand_id, CAST(NULL AS string) AS party,
        {code} AS prim_code,
        'lens' AS source, 'n' AS sensitive, 'n' AS "foreign", 'y' AS active,
        2000 AS cycle_year, 'cmtes.txt' AS source_file
      FROM {t('part')}"""

    return (xw("CASE WHEN p_partkey % 20 <> 0 THEN NULL WHEN p_partkey % 80 = 0 THEN 'k' ELSE 'K' END"
               " || cast(p_size % 4 as string)", "")
            + " UNION ALL "
            + xw("CASE WHEN p_partkey % 60 = 0 THEN 'K' || cast((p_size + 1) % 4 as string) END", "B"))


# Lines that delimited_lines_sql spoils: a field too few, then a field too many.
SHORT_LINE = "image_num LIKE '%7'"
LONG_LINE = "image_num LIKE '%31'"
BAD_LINE = f"{SHORT_LINE} OR {LONG_LINE}"


def delimited_lines_sql(dialect: str, columns: list[str], raw: str = "{raw}") -> str:
    """The rows of a raw table as pipe-delimited lines (value, lineage), some spoiled."""
    fields = [f"coalesce({c}, '')" for c in columns]
    return f"""
      SELECT concat_ws('|', {', '.join(fields[:-1])}) || CASE
               WHEN {SHORT_LINE} THEN '' ELSE '|' || {fields[-1]} END
             || CASE WHEN {LONG_LINE} THEN '|extra' ELSE '' END AS value,
             cycle_year, source_file
      FROM {raw}"""


# The two PAC files: in ``quoted`` the name is wrapped in quotes and holds a separator and quotes.
FILING_FILE = "CASE WHEN sub_id LIKE '%_2' OR sub_id LIKE '%_5' THEN 'quoted' ELSE 'plain' END"
FILING_NAME = f"name || CASE WHEN {FILING_FILE} = 'quoted' THEN '|say \"hi\"' ELSE '' END"
BAD_BYTES = "image_num LIKE '%53'"


def filing_lines_sql(columns: list[str], raw: str = "{raw}") -> str:
    """The rows of the PAC table as lines (value, bad_bytes, lineage) of two files; Spark only."""
    quoted = f"CASE WHEN {FILING_FILE} = 'quoted' THEN '\"' || replace({FILING_NAME}, '\"', '\"\"') || '\"' ELSE name END"
    fields = [f"coalesce({quoted if c == 'name' else c}, '')" for c in columns]
    return f"""
      SELECT concat_ws('|', {', '.join(fields[:-1])}) || CASE
               WHEN {SHORT_LINE} THEN '' ELSE '|' || {fields[-1]} END
             || CASE WHEN {LONG_LINE} THEN '|extra' ELSE '' END AS value,
             coalesce({BAD_BYTES}, false) AS bad_bytes, cycle_year, {FILING_FILE} AS source_file
      FROM {raw}"""


def link_files_sql(raw: str = "{raw}") -> str:
    """The link rows dealt over the files f0 to f4 by supplier; a seventh of them come late."""
    supplier = "cast(regexp_extract(linkage_id, '([0-9]+)', 1) as bigint)"
    return f"""
      SELECT cand_id, cand_election_yr, fec_election_yr, cmte_id, cmte_tp, cmte_dsgn, linkage_id, cycle_year,
             'f' || cast({supplier} % 5 as string) AS source_file, {supplier} % 7 = 3 AS late
      FROM {raw}"""


def listing_sql(part: str = "{part}") -> str:
    """A file listing: names recur in every cycle and type, some sizes are 0 (unknown)."""
    return f"""
      SELECT cast(1980 + 2 * (p_partkey % 23) as int) AS cycle_year,
             CASE p_partkey % 3 WHEN 0 THEN 'indiv' WHEN 1 THEN 'pas2' ELSE 'cn' END AS file_type,
             'f' || cast(p_partkey % 40 as string) || '_' || cast(cast(floor(p_partkey / 2760) as bigint) as string)
               || '.zip' AS file_name,
             cast(CASE WHEN p_partkey % 50 = 7 THEN 0 ELSE p_size * 1000 END as bigint) AS file_size
      FROM {part}"""


def manifest_sql(part: str = "{part}") -> str:
    """What was recorded: two thirds of the listing, some with another size, some twice."""
    base = listing_sql(part).replace("AS file_size", "+ CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS file_size")
    return (base + " WHERE p_partkey % 3 <> 2 OR p_partkey % 4 = 0 UNION ALL "
            + base + " WHERE p_partkey % 8 = 0")


LENS_TABLES = [
    "candidates", "committees", "pac_contributions", "individual_contributions",
    "candidate_committee_linkage", "candidate_financial_summary", "opensecrets_committees",
]


def lens_sql(table: str, dialect: str, t=None) -> str:
    """SQL text of one lens table; ``t`` maps a source name to its reference."""
    if t is None:
        t = (lambda name: "{" + name + "}") if dialect == "spark" else (lambda name: name)
    builders = {
        "candidates": lambda: _candidates(t),
        "committees": lambda: _committees(t),
        "pac_contributions": lambda: _pac(t, dialect),
        "individual_contributions": lambda: _individual(t, dialect),
        "candidate_committee_linkage": lambda: _linkage(t),
        "candidate_financial_summary": lambda: _financials(t),
        "opensecrets_committees": lambda: _crosswalk(t),
    }
    sql = builders[table]()
    if dialect == "spark":
        # spark.sql treats braces as argument references; '"foreign"' is a
        # DuckDB-quoted name, written with back-quotes on Spark.
        sql = sql.replace('"foreign"', "`foreign`")
    return sql


def read_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCE_TABLES}


def lens_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All raw tables of the lens as lazy DataFrames over ``sf_dir``."""
    src = read_sources(spark, sf_dir)
    out = {}
    for table in LENS_TABLES:
        sql = lens_sql(table, "spark")
        used = {k: v for k, v in src.items() if "{" + k + "}" in sql}
        out[table] = spark.sql(sql, **used)
    return out
