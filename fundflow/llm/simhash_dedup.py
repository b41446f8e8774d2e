"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits.  Two
fingerprints at most ``2`` bits apart agree exactly in one segment at least
(two errors, three segments) and differ by two bits at most in any other.  So
each fingerprint gets keys (exact segment i, codeword index of segment i+1).
The index comes from the perfect Golay code (23, 12): the segment and every
word one flip away are decoded to their nearest codeword, up to a few indices
in all.  Segments two bits apart share the word half-way, hence an index.
Candidates sharing a key are verified by their bit distance.

Keys held by more than ``BUCKET`` fingerprints form no pairs: their
fingerprints are linked through the 65 words of the radius-1 ball, which is
exact for distance 2 and at most 65 fingerprints share a word.

Cases: null or blank text has fingerprint zero and is linked like any other;
texts under three words are one shingle; equal texts share a fingerprint;
repeated rows each keep a row; a null doc_id keeps its row, never names a
component unless all of it is null; an empty table gives an empty result;
extra columns are ignored here and kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (hex16, lower_ascii, majority_bits, shingle_structs, text_key, vote_sums,
                     words_of, written)
from .graph import components

SHINGLE = 3
MAX_BITS = 2
BUCKET = 64
SEGMENTS = ((0, 22), (22, 21), (43, 21))      # (first bit, width) of a 64-bit fingerprint
GENERATOR = 0b101011100011                    # x^11+x^9+x^7+x^6+x^5+x+1


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words modulo the generator polynomial."""
    out = word.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        out ^= np.where((out >> bit) & 1, GENERATOR << (bit - 11), 0)
    return out


def _leaders() -> np.ndarray:
    """Error pattern by syndrome: the 2,048 patterns of weight three or less, each its own."""
    flips = [0] + [1 << i for i in range(23)]
    patterns = np.array(sorted({a | b | c for a in flips for b in flips for c in flips}))
    table = np.zeros(2048, dtype=np.int64)
    table[_syndrome(patterns)] = patterns
    return table


def golay_index(word: np.ndarray, leaders: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    return (word ^ leaders[_syndrome(word)]) >> 11


def fuzzy_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row number, key) of every distinct key of each 64-bit fingerprint (unsigned)."""
    leaders = _leaders()
    segment = [((fingerprints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
               for at, width in SEGMENTS]
    rows, keys = [], []
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        flips = np.array([0] + [1 << b for b in range(SEGMENTS[j][1])], dtype=np.int64)
        index = np.sort(golay_index(segment[j][:, None] ^ flips[None, :], leaders), axis=1)
        fresh = np.ones(index.shape, dtype=bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :-1]
        row, at = np.nonzero(fresh)
        rows.append(row)
        keys.append((np.int64(i) << 34) | (segment[i][row] << 12) | index[row, at])
    return np.concatenate(rows), np.concatenate(keys)


def _with_keys(batches):
    for pdf in batches:
        fp = pdf["fp"].to_numpy(dtype=np.int64)
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            row, key = fuzzy_keys(part.view(np.uint64))
            yield pd.DataFrame({"key": key, "fp": part[row]})


def fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp long) per row of ``docs``; words lower-cased A-Z, h = xxhash64."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                       F.monotonically_increasing_id().alias("rid"),
                       words_of(lower_ascii(text)).alias("words"))
    runs = base.select("rid", "doc_id", "text_key",
                       F.explode_outer(shingle_structs(F.col("words"), shingle)).alias("s"))
    parts = F.concat_ws(" ", *[F.col(f"s.w{i}") for i in range(shingle)])
    h = F.when(F.col("s").isNotNull(), F.xxhash64(parts)).otherwise(F.lit(0).cast("long"))
    votes = runs.select("rid", "doc_id", "text_key", h.alias("h"),
                        F.col("s").isNotNull().cast("long").alias("one")) \
                .groupBy("rid", "doc_id", "text_key") \
                .agg(F.sum("one").alias("n"), *vote_sums(F.col("h")))
    return votes.select("doc_id", "text_key", majority_bits(F.col("n")).alias("fp"))


def near_edges(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links that connect distinct fingerprints ``fp`` at most ``max_bits`` (<= 2) apart.

    Small buckets give every verified pair; large ones give stars whose
    members are all within two bits of their centre.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the key scheme covers distances up to 2 bits")
    keyed = fps.select("fp").mapInPandas(_with_keys, "key long, fp long")
    size = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = written(keyed.join(size, "key").select("key", "fp", "n"), "golay-keys")
    small = shared.filter(F.col("n") <= bucket).select("key", "fp")
    pairs = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), "key")
             .filter((F.col("a") < F.col("b"))
                     & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    if max_bits < 2:
        ball = [0]                                # equal words only; one flip below joins by it
        ball += [1 << i for i in range(64)] if max_bits == 1 else []
    else:
        ball = [0] + [1 << i for i in range(64)]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in ball]
    hot = shared.filter(F.col("n") > bucket).select("fp").distinct()
    spread = hot.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x).cast("long"))
                                                  for x in signed])).alias("mid"))
    if max_bits == 1:                             # a link is a fingerprint in another's ball
        stars = spread.join(hot.select(F.col("fp").alias("b")), F.col("mid") == F.col("b")) \
                      .select(F.col("fp").alias("a"), "b").filter("a != b")
    else:
        centre = spread.groupBy("mid").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")) \
                       .filter("n > 1").select("mid", "a")
        stars = spread.join(centre, "mid").select("a", F.col("fp").alias("b")).filter("a != b")
    return pairs.unionByName(stars)


def near_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    bucket: int = BUCKET) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) per row.

    component_id is the least doc_id reachable, root the component's least fingerprint.

    Exact copies meet in one row of (fp, least doc_id) before any join, so a
    group holding a third of all rows is pre-aggregated where it is read.
    """
    prints = written(fingerprint(docs, shingle), "fingerprints")
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = components(near_edges(fps, max_bits, bucket), "near-links")
    labelled = fps.join(rooted, F.col("fp") == F.col("node"), "left") \
                  .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    member = labelled.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return prints.join(member, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return hex16(fp)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of near-duplicates: its least (doc_id, text), all columns kept.

    A component without any doc_id keeps the row with the least text key.
    """
    groups = near_components(docs, shingle, max_bits)
    least = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))) \
                  .groupBy("root", "doc_id", "text_key") \
                  .agg(F.count(F.lit(1)).alias("copies")) \
                  .groupBy("root", "doc_id") \
                  .agg(F.min(F.struct("text_key", "copies")).alias("row"))
    rows = written(least.select(F.col("doc_id").alias("kept_id"),
                                F.col("row.text_key").alias("kept_key"),
                                F.col("row.copies").alias("copies")), "kept")
    once = rows.filter("copies = 1").select("kept_id", "kept_key")
    more = rows.filter("copies > 1").select("kept_id", "kept_key")

    def held(keys, kind):
        return docs.join(keys, docs.doc_id.eqNullSafe(keys.kept_id)
                         & (text_key(docs.text) == keys.kept_key), kind)

    kept = held(once, "left_semi")
    if more.isEmpty():
        return kept
    firsts = held(more, "inner").groupBy(more.kept_id, more.kept_key).agg(
        F.first(F.struct(*[docs[c] for c in docs.columns])).alias("row"))
    return kept.unionByName(firsts.select("row.*"))
