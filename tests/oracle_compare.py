"""Run a registered query on Spark and its oracle SQL on DuckDB, and compare.

Rows are compared as multisets after sorting columns by name; values are
compared exactly (decimals by value, doubles bit for bit).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb


ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, decimal.Decimal):
        return (2, str(v.normalize()) if v == v.to_integral() else format(v.normalize(), "f"))
    if isinstance(v, float):
        if math.isnan(v):
            return (3, "nan")
        return (3, repr(v))
    if isinstance(v, int):
        return (4, str(v))
    if isinstance(v, dt.datetime):
        return (5, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (6, v.isoformat())
    return (7, str(v))


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str):
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark-only {sorted(set(s_names) - set(d_names))}, "
                        f"oracle-only {sorted(set(d_names) - set(s_names))}")
        return problems, len(s_rows), len(d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count {len(s_rows)} vs {len(d_rows)}")
    a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
    if a != b:
        sa, sb = set(a), set(b)
        names = sorted(s_names)
        ex_a = sorted(sa - sb)[:2]
        ex_b = sorted(sb - sa)[:2]
        diff_cols = set()
        for x in ex_a:
            for y in ex_b:
                diff_cols |= {names[i] for i in range(len(names)) if x[i] != y[i]}
        problems.append(f"values differ ({len(sa - sb)} spark-only rows); columns {sorted(diff_cols)[:8]}; "
                        f"spark {ex_a[:1]} oracle {ex_b[:1]}")
    return problems, len(s_rows), len(d_rows)
