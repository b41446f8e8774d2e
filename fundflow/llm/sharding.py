"""Shards by jump consistent hashing.

A row's shard follows from its key and the number of shards alone; no ring table
is kept.  The key's hash seeds a generator whose jumps name, in rising order, the
shard counts at which the key moves; the last jump below the count is its shard.
Adding a shard moves a key into the new one or leaves it.

Rows get gapless slots within a shard: buckets of a shard (by key hash, as many as
the input asks for) are numbered one after the other, and rows within a bucket
by key, text and size, so a shard with billions of rows is no single task.

Cases: a null key is a key like any other; rows with one key share a shard; null text
counts 0 bytes and the CRC of the empty string; repeated rows get slots of their
own; an empty table gives an empty result; extra columns are kept, the columns
added here replace theirs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARDS = 40
OVERHEAD = 16                                  # bytes a row takes besides its text
ROWS_PER_BUCKET = 50_000
MOST_BUCKETS = 100_000
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard (0 to shards - 1) of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.uint64)
    shard, ahead = np.zeros(len(state), dtype=np.int64), np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    while len(going):
        shard[going] = ahead[going]
        state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = ((shard[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        going = going[ahead[going] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a column's value; the key is hashed as text, so its type doesn't matter."""
    @F.pandas_udf("int")
    def run(h: pd.Series) -> pd.Series:
        return pd.Series(jump(h.to_numpy(dtype=np.int64).view(np.uint64), shards).astype(np.int32))

    return run(F.xxhash64(key.cast("string")))


def assign(docs: DataFrame, key: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """``docs`` without its text, plus size, text_crc32, law, shard, slot, grown_shard."""
    kept = [c for c in docs.columns if c not in (*ADDED, "text")]
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    # texts are read once; what follows works on the narrow table
    sized = written(docs.select(*kept, (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                                F.crc32(text).alias("text_crc32")), "sizes")
    n = sized.count()                          # from the file footers
    sized = sized.withColumn("shard", shard_of(F.col(key), shards)) \
                 .withColumn("grown_shard", shard_of(F.col(key), shards + 1))
    buckets = max(16, min(MOST_BUCKETS, n // (ROWS_PER_BUCKET * shards) + 1))
    rows = sized.withColumn("_bucket", F.pmod(F.xxhash64(key, "text_crc32"), F.lit(buckets)))
    sizes = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select(
        F.col("shard").alias("_s"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_rows").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(
        key, "text_crc32", "size"))
    numbered = rows.withColumn("_within", within)
    # at most shards x MOST_BUCKETS rows; only a small table is sent to every executor
    offsets = F.broadcast(before) if shards * buckets <= 100_000 else before
    return numbered.join(offsets, (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b"))) \
        .select(*kept, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                (F.col("_before") + F.col("_within") - 1).alias("slot"), "grown_shard")
