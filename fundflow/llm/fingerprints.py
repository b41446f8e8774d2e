"""Document fingerprints: weighted SimHash and permuted block tables, in DataFrame functions only.

Terms are a text's words and pairs of neighbouring words (A-Z lower-cased).
Each occurrence votes with the weight of its term, its length in characters:
long terms say more than the short ones that every text shares.  A bit is set
where the weights of the terms whose hash sets it exceed half of all weights.

``near`` finds every fingerprint within ``radius`` bits.  The 64 bits are cut
into ``blocks`` blocks; each table keeps the fingerprints by all but
``radius`` of the blocks.  Two fingerprints within the radius agree on at
least that many blocks, so one table at least brings them together; a pair is
taken from the first such table only and verified by its bit distance.

Cases: null text is empty; an empty or blank text has no terms and
fingerprint zero; equal texts have equal fingerprints; rows of one doc_id are
ordered by their text; a null doc_id comes last in descending order; one row
alone is its own next document; an empty table gives an empty result; extra
columns are ignored.  Votes are exact up to 2^31 characters of terms a text.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import PAIR, hex16, lower_ascii, majority_bits, words_of, written

RADIUS = 3
BLOCKS = 5
ROWS_PER_BUCKET = 20000                       # rows whose neighbours one task looks up at a time
BYTES_PER_BUCKET = 32 << 20                   # and bytes of their texts
BYTES_PER_TASK = 128 << 20
LEAST_BUCKETS = 400
MOST_BUCKETS = 200000


def simhash(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(*keys, fp long) per distinct ``keys`` of ``texts``; rows of equal keys must have equal texts.

    If ``texts`` is already partitioned by some of the keys no shuffle follows.
    """
    words = texts.select(*keys, words_of(lower_ascii(F.coalesce(F.col(text), F.lit(""))))
                         .alias("words"))
    pairs = F.arrays_zip(F.col("words").alias("a"),
                         F.slice("words", F.lit(2), F.size("words")).alias("b"))
    terms = words.select(*keys, F.explode_outer(
        pairs.cast("array<struct<a:string,b:string>>")).alias("t"))
    word, pair = F.col("t.a"), F.concat_ws(" ", F.col("t.a"), F.col("t.b"))
    length = F.coalesce(F.char_length(word), F.lit(0)).cast("long")
    both = F.when(F.col("t.b").isNotNull(), F.char_length(pair)).otherwise(F.lit(0)).cast("long")
    votes = terms.select(*keys, F.xxhash64(word).alias("h1"), F.xxhash64(pair).alias("h2"),
                         length.alias("w1"), both.alias("w2"))
    bits = [F.sum(F.shiftrightunsigned("h1", b).bitwiseAND(F.lit(PAIR)) * F.col("w1")
                  + F.shiftrightunsigned("h2", b).bitwiseAND(F.lit(PAIR)) * F.col("w2"))
            .alias(f"v{b}") for b in range(32)]
    sums = votes.groupBy(*keys).agg(F.sum(F.col("w1") + F.col("w2")).alias("total"), *bits)
    return sums.select(*keys, majority_bits(F.col("total")).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the 64 bits on which two fingerprints agree."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    ladder = F.lit(bounds).cast("array<bigint>")
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(x) for x in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds))
                                & (F.get(ladder, at + step - 1) < key), at + step).otherwise(at))


def with_next(docs: DataFrame) -> DataFrame:
    """(bucket, rn, lent, doc_id, text, next_text): each row beside the next by descending doc_id.

    Rows are dealt into buckets of neighbouring ids, even in rows and in bytes of text; the
    bounds are percentiles (at most MOST_BUCKETS numbers, whatever the input).  Each bucket is lent the
    first row of the bucket that follows (``lent`` is true), the last one the
    first of all, so one shuffle of the texts is enough.  ``rn`` orders a bucket.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    n, held = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    wanted = min(MOST_BUCKETS, max(LEAST_BUCKETS, n // ROWS_PER_BUCKET, held // BYTES_PER_BUCKET))
    # a row counts once, and once more for each mean text that its text is long: at most twice the rows in all
    weight = F.floor(size / max(1, held // max(1, n))).cast("int") + 1
    bounds = docs.select(F.explode(F.array_repeat("doc_id", weight)).alias("doc_id")).agg(F.percentile_approx(
        "doc_id", [i / wanted for i in range(1, wanted)], max(10000, 2 * wanted))).first()[0]
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key")) \
               .withColumn("bucket", _bucket(F.col("key"), sorted(set(bounds or []))))
    heads = rows.groupBy("bucket").agg(F.max("key").alias("first_key"))
    up = Window.orderBy("bucket")                 # one row a bucket: at most MOST_BUCKETS
    heads = heads.select(F.col("bucket").alias("own"), "first_key", F.coalesce(
        F.lead("bucket").over(up), F.min("bucket").over(Window.partitionBy())).alias("to"))
    lent = rows.join(F.broadcast(heads), (F.col("bucket") == F.col("own")) & (F.col("key") == F.col("first_key"))) \
               .groupBy("to").agg(F.min_by(F.struct("doc_id", "key"), "text").alias("id"),
                                  F.min("text").alias("text"))
    every = rows.select("bucket", F.lit(False).alias("lent"), "key", "doc_id", "text").unionByName(
        lent.select(F.col("to").alias("bucket"), F.lit(True).alias("lent"),
                    F.col("id.key").alias("key"), F.col("id.doc_id").alias("doc_id"), "text"))
    tasks = held // BYTES_PER_TASK
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        every = every.repartition(tasks, "bucket")
    order = Window.partitionBy("bucket").orderBy("lent", F.desc("key"), "text")
    return every.select("bucket", F.row_number().over(order).alias("rn"), "lent", "doc_id", "text",
                        F.lead("text").over(order).alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """``text`` whose last third is replaced by as many first code points of ``following``."""
    n = F.char_length(text)
    k = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k),
                    F.substring(F.coalesce(following, F.lit("")), F.lit(1), k))


def compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next) per row."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    base = ["bucket", "rn", "lent", "doc_id", "n_chars", "edited_sha256"]
    texts = rows.select(
        "bucket", "rn", "lent", "doc_id", F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.inline(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("t")),
                         F.struct(F.lit(1).alias("which"), F.col("edited").alias("t"))))) \
        .filter(~(F.col("lent") & (F.col("which") == 1)))
    prints = simhash(texts, [*base, "which"], "t").groupBy(*base).agg(
        F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
        F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    following = F.lead("fp").over(Window.partitionBy("bucket").orderBy("rn"))
    return prints.withColumn("next_fp", following).filter("not lent").select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


def _blocks(blocks: int) -> list[int]:
    edge = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [(1 << edge[i + 1]) - (1 << edge[i]) for i in range(blocks)]


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("long")


def _tables(fp: Column, blocks: int, radius: int) -> Column:
    """Array of (kept blocks, bits up to the last of them, key): one entry per permuted table."""
    masks = _blocks(blocks)
    return F.array(*[
        F.struct(F.lit(sum(1 << i for i in kept)).alias("kept"),
                 F.lit((1 << (max(kept) + 1)) - 1).alias("upto"),
                 fp.bitwiseAND(_long(sum(masks[i] for i in kept))).alias("key"))
        for kept in combinations(range(blocks), blocks - radius)])


def near(prints: DataFrame, queries: DataFrame, radius: int = RADIUS,
         blocks: int = BLOCKS) -> DataFrame:
    """(query_fp, fp, bits): every fp of ``prints`` within ``radius`` bits of each of ``queries``.

    Both have a column fp of distinct values.  Tables are rows keyed by the
    blocks kept, so a hot block is an ordinary skewed join key that AQE splits.
    """
    if not 0 <= radius < blocks <= 16:
        raise ValueError("radius must be below the number of blocks")
    tables = lambda df, name: df.select(
        F.col("fp").alias(name), F.inline(_tables(F.col("fp"), blocks, radius)))
    asked = tables(queries, "query_fp").withColumnRenamed("upto", "u")
    apart = F.col("query_fp").bitwiseXOR(F.col("fp"))
    same = sum((F.when(apart.bitwiseAND(_long(m)) == 0, 1 << i).otherwise(0)
                for i, m in enumerate(_blocks(blocks))), F.lit(0))
    return tables(prints, "fp").join(asked, ["kept", "key"]) \
        .filter((F.bit_count(apart) <= radius) & (same.bitwiseAND(F.col("upto")) == F.col("kept"))) \
        .select("query_fp", "fp", F.bit_count(apart).alias("bits"))


def with_neighbours(rows: DataFrame, asked: Column, radius: int = RADIUS,
                    blocks: int = BLOCKS) -> DataFrame:
    """``rows`` plus ``near_docs``: other documents within the radius, for the rows ``asked`` for."""
    rows = written(rows, "doc-fingerprints")
    sizes = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("docs"))
    found = near(sizes.select("fp"), rows.filter(asked).select("fp").distinct(), radius, blocks)
    counts = found.join(sizes, "fp").groupBy("query_fp") \
                  .agg((F.sum("docs") - 1).alias("near_docs"))
    queried = rows.filter(asked).join(counts, F.col("fp") == F.col("query_fp"), "left") \
                  .drop("query_fp")
    return queried.unionByName(rows.filter(~F.coalesce(asked, F.lit(False)))
                               .withColumn("near_docs", F.lit(None).cast("long")))


def fingerprint_hex(fp: Column) -> Column:
    return hex16(fp)
