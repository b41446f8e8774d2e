"""Data-quality checks on raw tables: not-null and unique keys.

Each table is read once: a grouped count by its key (map-side partial
counts, so a hot or NULL key is pre-reduced before the shuffle) answers both
its not-null and its unique checks.  A failing unique check reports how many
distinct key values repeat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY

# (raw table, column) pairs checked for NULLs; the same minus the amount are
# checked for uniqueness.
NOT_NULL_CHECKS = [
    ("individual_contributions", "sub_id"),
    ("individual_contributions", "transaction_amt"),
    ("pac_contributions", "sub_id"),
    ("candidates", "cand_id"),
    ("committees", "cmte_id"),
    ("candidate_committee_linkage", "linkage_id"),
]
# (raw table, column) pairs whose NULL leaves a flag NULL, so that the row takes no part in
# the flow: a missing type of a non-negative amount, a missing entity type.
UNKNOWN_FLAG_CHECKS = [
    ("individual_contributions", "transaction_tp"),
    ("individual_contributions", "entity_tp"),
    ("pac_contributions", "transaction_tp"),
]
UNIQUE_CHECKS = [
    ("individual_contributions", "sub_id"),
    ("pac_contributions", "sub_id"),
    ("candidates", "cand_id"),
    ("committees", "cmte_id"),
    ("candidate_committee_linkage", "linkage_id"),
]


def duplicate_keys(df: DataFrame, column: str, per_cycle: bool = True) -> DataFrame:
    """Key values (and cycle, when scoped) that occur more than once."""
    keys = [column, "cycle_year"] if per_cycle else [column]
    return (df.filter(F.col(column).isNotNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def unknown_flag(column: str) -> Column:
    """Rows with an amount that ``column``'s NULL keeps out of the flow."""
    amount = F.col("transaction_amt").cast(MONEY)
    typed = (amount >= 0) if column == "transaction_tp" else amount.isNotNull()
    return F.col(column).isNull() & typed


def _table_report(df: DataFrame, table: str, key: str, other_not_null: list[str],
                  per_cycle: bool) -> DataFrame:
    """All checks of one table from a single grouped pass over it.

    Grouping by the key (and cycle) gives both answers: the NULL-key group's
    row count is the key's NULL count, and the non-NULL groups with more than
    one row are the repeated keys.  Other not-null counts ride along as sums.
    """
    keys = [key, "cycle_year"] if per_cycle else [key]
    flags = [c for t, c in UNKNOWN_FLAG_CHECKS if t == table]
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in other_not_null],
        *[F.count_if(unknown_flag(c)).alias(f"_flag_{c}") for c in flags])
    totals = groups.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("_null_key"),
        F.count_if(F.col(key).isNotNull() & (F.col("_n") > 1)).alias("_dup_keys"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in other_not_null],
        *[F.coalesce(F.sum(f"_flag_{c}"), F.lit(0)).alias(f"_flag_{c}") for c in flags])
    checks = [("not_null", key, "_null_key")] + [("not_null", c, f"_null_{c}")
                                                  for c in other_not_null]
    checks = [c for c in checks if (table, c[1]) in NOT_NULL_CHECKS]
    if (table, key) in UNIQUE_CHECKS:
        checks.append(("unique", key, "_dup_keys"))
    checks += [("flag_known", c, f"_flag_{c}") for c in flags]
    # one totals row -> one output row per check, without re-reading the table
    rows = F.array(*[F.struct(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                              F.lit(column).alias("column_name"),
                              F.col(value).cast("long").alias("failing_rows"))
                     for check, column, value in checks])
    return totals.select(F.inline(rows)).withColumn("passed", F.col("failing_rows") == 0)


def quality_report(raw: dict[str, DataFrame], per_cycle: bool = True) -> DataFrame:
    """One row per check: name, table, column, failing rows, passed.

    One grouped pass per table (the largest table is read once, not once per
    check).
    """
    parts = []
    for table, key in UNIQUE_CHECKS:
        others = [c for t, c in NOT_NULL_CHECKS if t == table and c != key]
        parts.append(_table_report(raw[table], table, key, others, per_cycle))
    return reduce(DataFrame.unionByName, parts)


def load_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows per (table, cycle, source file)."""
    parts = [df.groupBy("cycle_year", "source_file").agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("table_name"), "cycle_year", "source_file", "rows")
             for name, df in raw.items()]
    return reduce(DataFrame.unionByName, parts)


def load_total(raw: dict[str, DataFrame]) -> DataFrame:
    """Grand total of loaded rows, and the number of (table, file) loads."""
    return load_counts(raw).agg(F.sum("rows").cast("long").alias("total_rows"),
                                F.count(F.lit(1)).alias("loads"))
