"""Exact median per key from a value histogram (no object aggregate).

``percentile`` keeps a map of values per group and runs as an object
aggregate, which falls back to sorting every input row once a task holds
more than a few dozen groups.  Here the rows are first counted per
(key, value) with an ordinary hash aggregate (map-side combine), so a key
holding a third of all rows shrinks to one row per distinct value.

The running count that locates the two middle values never puts a whole key
in one task either: the histogram is range-partitioned on (key, value) and
written as a table, each task's block of a key gets its offset from a small table
of per-(task, key) weights (at most #tasks + #keys rows), and the rest of the
running count stays inside the block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_table
from .joins import null_safe_on


def median_of_integers(df: DataFrame, key: str | list[str], value: str, out: str,
                       num_partitions: int | None = None) -> DataFrame:
    """Per ``key`` (one column or several): ``lo + (hi - lo) div 2`` of the two middle values (integers).

    That is the linear-interpolated median with the half dropped toward the
    lower value; with money in cents it is the median cut to whole cents.
    Keys whose values are all NULL are absent from the result.
    """
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hist = (df.filter(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
    order = [*[F.col(k).asc_nulls_last() for k in keys], F.col(value).asc()]
    blocks = shared_table(             # stable task ids for both passes
        hist.repartitionByRange(num_partitions, *order)
        .withColumn("_pid", F.spark_partition_id()), "median-histogram")
    # weight of every (task, key) block, and of the blocks before it in the key
    per_block = blocks.groupBy("_pid", *keys).agg(F.sum("_n").alias("_w"))
    in_key = Window.partitionBy(*keys)
    before = in_key.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per_block = per_block.select(
        F.col("_pid").alias("_b_pid"), *[F.col(k).alias(f"_b_{k}") for k in keys],
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_before"),
        F.sum("_w").over(in_key).alias("_total"))
    # at most #tasks + #keys rows; AQE broadcasts it on its real size
    rows = blocks.join(per_block, null_safe_on(blocks, per_block,
                                               [("_pid", "_b_pid")] + [(k, f"_b_{k}") for k in keys]))
    local = (Window.partitionBy("_pid", *keys).orderBy(value)
             .rowsBetween(Window.unboundedPreceding, 0))
    upto = F.col("_before") + F.sum("_n").over(local)
    h = rows.select(*keys, value, upto.alias("_upto"), "_total")
    lo_pos = F.floor((F.col("_total") - 1) / 2)
    hi_pos = F.ceil((F.col("_total") - 1) / 2)
    picked = h.groupBy(*keys).agg(
        F.min(F.when(F.col("_upto") > lo_pos, F.col(value))).alias("_lo"),
        F.min(F.when(F.col("_upto") > hi_pos, F.col(value))).alias("_hi"))
    return picked.select(*keys, (F.col("_lo") + F.floor((F.col("_hi") - F.col("_lo")) / 2))
                         .cast("long").alias(out))
