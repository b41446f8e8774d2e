"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\u000b\f\r"                    # \x20 \x09-\x0D
PAIR = (1 << 32) + 1                          # one vote counter in each half of a long


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder on the shared storage named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table on shared storage: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character kept."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
            .otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")) \
            .otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def shingle_structs(words: Column, n: int) -> Column:
    """Array of structs w0..w(n-1), one per run of ``n`` words, repeats included.

    Fewer than ``n`` words give the whole sequence in one struct (null beyond
    it); no words give an empty array.
    """
    kind = "array<struct<" + ",".join(f"w{i}:string" for i in range(n)) + ">>"
    count = F.size(words) - n + 1
    runs = F.arrays_zip(*[F.slice(words, F.lit(i + 1), count) for i in range(n)])
    short = F.array(F.struct(F.concat_ws(" ", words),
                             *[F.lit(None).cast("string") for _ in range(n - 1)]))
    return F.when(count >= 1, runs.cast(kind)) \
            .when(F.size(words) > 0, short.cast(kind)) \
            .otherwise(F.array().cast(kind))


def vote_sums(h: Column, weight: Column | None = None) -> list[Column]:
    """Aggregates v0..v31: v[b] counts bit b of ``h`` in its low half, bit b+32 in its high half.

    Both counters stay exact while a group's total weight is below 2^31.
    """
    bits = [F.shiftrightunsigned(h, b).bitwiseAND(F.lit(PAIR)) for b in range(32)]
    return [F.sum(x if weight is None else x * weight).alias(f"v{b}")
            for b, x in enumerate(bits)]


def majority_bits(total: Column) -> Column:
    """64-bit value whose bit is set where its votes exceed half of ``total``."""
    out = F.lit(0).cast("long")
    for b in range(32):
        low = F.col(f"v{b}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"v{b}"), 32)
        for votes, at in ((low, b), (high, b + 32)):
            one = (1 << at) - (1 << 64 if at == 63 else 0)
            out = out.bitwiseOR(F.when(votes * 2 > total, F.lit(one).cast("long"))
                                 .otherwise(F.lit(0).cast("long")))
    return out


def hex16(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def text_key(text: Column) -> Column:
    """Hash that tells rows of one doc_id apart; equal texts share it."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
