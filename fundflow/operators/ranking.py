"""Exact percent_rank and ntile without putting a whole partition in one task.

A window ``OVER (PARTITION BY k ORDER BY s)`` sends every row of ``k`` to one
task.  Both rankings here are exact and stay distributed:

* ``percent_rank`` only needs, per row, how many rows of its partition have a
  smaller value.  A histogram ``(k, value) -> count`` is pre-aggregated on the
  mappers; the cumulative count runs over that histogram (one row per
  distinct value, at most 1,001 for a score rounded to 0.1 in [0, 100]) and
  is joined back.
* A column with many distinct values has the histogram itself ranged over (k, value) and
  written: every tie group is one histogram row, so no group straddles two blocks.  Each
  block's offset comes from a table of block weights, and the cumulative count stays
  inside a block.
* ``ntile`` needs each row's position in a total order.  The rows are
  range-partitioned on (k, order, tie-breaker) so a large ``k`` spans many
  tasks; the narrow table is written, so task numbers are stable; each block
  (task, k) numbers its rows; then per-(task, k) counts (a table of at most
  #tasks + #k rows) give each task's offset inside ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_table
from .joins import null_safe_on


def percent_rank_by_histogram(df: DataFrame, partition_cols: list[str], value_col: str,
                              out_col: str) -> DataFrame:
    """Add ``out_col`` = percent_rank() OVER (PARTITION BY partition_cols ORDER BY value_col).

    One task runs over a partition's distinct values, so these must be few (a rounded
    score); many distinct values need the block form of ``ntile_distributed``.
    """
    hist = df.groupBy(*partition_cols, value_col).agg(F.count(F.lit(1)).alias("_c"))
    part = Window.partitionBy(*partition_cols)
    before = part.orderBy(value_col).rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_c").over(before), F.lit(0))
    n = F.sum("_c").over(part)
    pr = F.when(n > 1, below.cast("double") / (n - 1).cast("double")).otherwise(F.lit(0.0))
    hist = hist.select(*[F.col(c).alias(f"_h_{c}") for c in partition_cols + [value_col]],
                       pr.alias(out_col))
    # The histogram is tiny (<= distinct values per partition) and, built from a
    # checkpointed table, cheap: AQE sees its real size and broadcasts it.
    keys = [(c, f"_h_{c}") for c in partition_cols + [value_col]]
    joined = df.join(hist, null_safe_on(df, hist, keys), "inner")
    return joined.drop(*[f"_h_{c}" for c in partition_cols + [value_col]])


def counts_below(df: DataFrame, partition_cols: list[str], value_col: str) -> DataFrame:
    """(partition columns, value, _below, _total): rows of the partition with a smaller value, and all its rows.

    NULL values come last.  No task sees more than its range of the distinct values.
    """
    keys = [*partition_cols, value_col]
    hist = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    blocks = shared_table(hist.repartitionByRange(*[F.col(c).asc_nulls_last() for c in keys])
                          .withColumn("_pid", F.spark_partition_id()), "value-histogram")
    part = Window.partitionBy(*partition_cols)
    before = part.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    weights = blocks.groupBy("_pid", *partition_cols).agg(F.sum("_c").alias("_w")).select(
        F.col("_pid").alias("_w_pid"), *[F.col(c).alias(f"_w_{c}") for c in partition_cols],
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"), F.sum("_w").over(part).alias("_total"))
    # at most (#tasks + #partitions) rows
    rows = blocks.join(weights, null_safe_on(
        blocks, weights, [("_pid", "_w_pid")] + [(c, f"_w_{c}") for c in partition_cols]))
    local = Window.partitionBy("_pid", *partition_cols).orderBy(F.col(value_col).asc_nulls_last()) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("_c").over(local), F.lit(0))
    return rows.select(*keys, below.alias("_below"), "_total")


def percent_rank_distributed(df: DataFrame, partition_cols: list[str], value_col: str, out_col: str) -> DataFrame:
    """Add ``out_col`` = percent_rank() OVER (PARTITION BY partition_cols ORDER BY value_col NULLS LAST).

    For columns with any number of distinct values; no window holds a whole partition.
    """
    ranks = counts_below(df, partition_cols, value_col)
    rank = F.when(F.col("_total") > 1, F.col("_below").cast("double") / (F.col("_total") - 1).cast("double")) \
            .otherwise(F.lit(0.0))
    keys = [*partition_cols, value_col]
    ranks = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in keys], rank.alias(out_col))
    return df.join(ranks, null_safe_on(df, ranks, [(c, f"_r_{c}") for c in keys])) \
             .drop(*[f"_r_{c}" for c in keys])


def ntile_distributed(df: DataFrame, partition_cols: list[str], order_cols: list[str], key: str | list[str],
                      buckets: int, out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = ntile(buckets) OVER (PARTITION BY .. ORDER BY order_cols, key), NULLs last.

    ``key`` (one column or several) is unique.  Only the partition, order and key columns are
    ranged and written; the buckets are joined back on the key.
    """
    unique = [key] if isinstance(key, str) else list(key)
    if num_partitions is None:
        num_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = list(dict.fromkeys([*partition_cols, *order_cols, *unique]))
    in_order = [F.col(c).asc_nulls_last() for c in columns]
    # written, so that every later pass sees the same task numbers
    blocks = shared_table(df.select(*columns).repartitionByRange(num_partitions, *in_order)
                          .withColumn("_pid", F.spark_partition_id()), "ntile-positions")
    stats = blocks.groupBy("_pid", *partition_cols).agg(F.count(F.lit(1)).alias("_cnt"))
    part = Window.partitionBy(*partition_cols)
    before = part.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(
        F.col("_pid").alias("_s_pid"), *[F.col(c).alias(f"_s_{c}") for c in partition_cols],
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
        F.sum("_cnt").over(part).alias("_n"))
    # at most (#tasks + #partitions) rows; AQE broadcasts it on its real size
    keys = [("_pid", "_s_pid")] + [(c, f"_s_{c}") for c in partition_cols]
    joined = blocks.join(stats, null_safe_on(blocks, stats, keys), "inner")
    local = Window.partitionBy("_pid", *partition_cols).orderBy(
        *[F.col(c).asc_nulls_last() for c in dict.fromkeys([*order_cols, *unique])])
    pos = F.col("_before") + F.row_number().over(local) - 1            # 0-based
    n = F.col("_n")
    q = F.floor(n / buckets).cast("long")
    r = n - q * buckets
    threshold = r * (q + 1)
    bucket = (F.when(F.col("_pos") < threshold, F.floor(F.col("_pos") / (q + 1)) + 1)
              .otherwise(r + F.floor((F.col("_pos") - threshold) / F.nullif(q, F.lit(0))) + 1))
    found = joined.withColumn("_pos", pos).select(*[F.col(c).alias(f"_p_{c}") for c in unique],
                                                  bucket.cast("long").alias(out_col))
    return df.join(found, null_safe_on(df, found, [(c, f"_p_{c}") for c in unique])) \
             .drop(*[f"_p_{c}" for c in unique])
