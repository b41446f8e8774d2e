"""Phrase collocations by dynamic itemset counting over cyclic shard scans.

The documents are dealt over ``shards`` by a hash.  A stop scans one shard, and stops go round
the shards in a circle.  Words are counted from the first stop on; a phrase of two words is
counted as soon as both of its words have reached the threshold in what was scanned so far,
one of three words as soon as both of its word pairs have.  Each phrase is counted for one
full circle from the stop at which it became active, so lengths interleave and every count
is complete.  After a stop only phrases still in their circle, words, and complete phrases at
or above the threshold are kept.

The first shard is the largest (the others share an eighth).  Nearly every word then
reaches the threshold in it, most pairs start with a small shard and complete with the large
one, and the many rare pairs are shuffled once instead of being carried along.

Which stop activates a phrase is looked up by hash: one byte for each of 2^``BUCKET_BITS``
buckets holds the first stop after which a word (or pair) of the bucket had reached the
threshold.  Its size is fixed, so it is broadcast at any size of the corpus.  A shared bucket only
makes a phrase active early; it is then counted for a circle from there, so counts never change.

A task reads each language's texts in runs of about ``CHUNK`` bytes, numbers a run's words by an Arrow
dictionary and counts by array work; Spark adds the runs up, first in the task.  A phrase is held as one string,
its words joined by blanks, then a tab and the language (words hold neither), which keeps the
shuffled rows narrow.  No key gathers rows.

Cases: a null text is empty, a null lang is ``und``; texts without a word add nothing; repeated rows
count again; rows sharing a doc_id stay apart; a long text is read in slices, phrases across
them included; empty tables give an empty result; extra columns are ignored; ties end with the
phrase, in byte order.
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, written

LONGEST = 3
SHARDS = 2
BUCKET_BITS = 24
PART_BITS = 16
CHUNK = 3_000_000                             # bytes a task holds before it counts; word numbers take 21 bits
ROWS = 100_000                                # rows of a batch
SLICE = 1_000_000                             # bytes of a text read at once
SALTS = 32
EXACT = "decimal(38,0)"
BREAKS = ".,;:!?\n\x0b\x0c\r"
COUNTS = "key string, size int, start int, count long"

MARK = b"\xff"                                  # end of a piece; no UTF-8 text holds this byte

_FOLD = bytes.maketrans((UPPER + "\t" + BREAKS).encode(), LOWER.encode() + b" " + MARK * len(BREAKS))
_GAP = re.compile(f"[ \t{BREAKS}]".encode())


def _slices(text: bytes):
    """A text in slices cut at a gap: words are parted by blanks, a mark ends each piece."""
    at = 0
    while at < len(text):
        end = len(text)
        if at + SLICE < end and (gap := _GAP.search(text, at + SLICE)):
            end = gap.start()
        yield text[at:end].translate(_FOLD).replace(MARK, b" " + MARK + b" ")
        at = end
    yield MARK


def _numbered(parts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Different words of a run, the first one empty, and the run as places in them; 0 ends a piece."""
    coded = pc.split_pattern(pa.array([b" ".join(parts)], pa.large_binary()), b" ").flatten().dictionary_encode()
    words = coded.dictionary
    number = np.arange(1, len(words) + 1, dtype=np.int32)
    for word, code in ((MARK, 0), (b"", -1)):  # blanks in a row have an empty word between them
        place = pc.index(words, pa.scalar(word, words.type)).as_py()
        if place >= 0:
            number[place] = code
    codes = number[coded.indices.to_numpy()]
    return pa.concat_arrays([pa.array([b""], words.type), words]), codes[codes >= 0]


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    tail = b"\t" + lang.encode()
    return np.fromiter((xxhash.xxh64_intdigest(w + tail) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The later of two starts, 0 (never) unless both have one."""
    return np.where((a > 0) & (b > 0), np.maximum(a, b), 0).astype(np.int64)


def _run_counts(words: pa.Array, codes: np.ndarray, most: int, lang: str, stop: int, shards: int,
                starts: dict[int, np.ndarray]):
    """Record batches (key, size, start, count) of the active phrases that begin in the first ``most`` codes."""
    words = pc.if_else(pc.equal(words, pa.scalar(MARK, words.type)), pa.scalar(b"", words.type), words)
    spelled = words.cast(pa.large_string())
    text = lambda value: pa.scalar(value, spelled.type)
    ending = pc.binary_join_element_wise(spelled, text("\t" + lang), text(""))

    def rows(size, start, parts, counts):
        for at in range(0, len(counts), ROWS):
            cut = slice(at, at + ROWS)
            taken = [(spelled if k < size - 1 else ending).take(pa.array(p[cut])) for k, p in enumerate(parts)]
            key = pc.binary_join_element_wise(*taken, text(" ")) if size > 1 else taken[0]
            yield pa.RecordBatch.from_arrays(
                [key.cast(pa.string()), pa.array(np.full(len(key), size, np.int32)),
                 pa.array(start[cut].astype(np.int32)), pa.array(counts[cut].astype(np.int64))],
                names=["key", "size", "start", "count"])

    def counted(size, active):
        """Rows of the phrases of ``size`` words; ``active`` gives the start of each by its words' numbers."""
        last = len(codes) - size + 1
        start = active(*[codes[k:last + k] for k in range(size)])[:most]
        begin = np.flatnonzero((start > 0) & (start + shards > stop))
        packed = codes[begin].astype(np.int64)
        for k in range(1, size):
            packed = packed << 21 | codes[begin + k]
        packed, counts = np.unique(packed, return_counts=True)
        parts = [packed >> 21 * k & 0x1FFFFF for k in range(size - 1, -1, -1)]
        yield from rows(size, active(*parts), parts, counts)

    if stop < shards:
        tally = np.bincount(codes[:most], minlength=1)
        tally[0] = 0
        seen = np.flatnonzero(tally)
        yield from rows(1, np.zeros(len(seen)), [seen], tally[seen])
    if not starts:
        return
    hashes = _word_hashes(words.to_pylist(), lang)
    if 1 in starts and stop < 2 * shards and len(codes) > 1:
        word_start = starts[1][_bucket(hashes)].copy()
        word_start[0] = 0
        yield from counted(2, lambda a, b: _both(word_start[a], word_start[b]))
    if 2 in starts and len(codes) > 2:
        def pair_start(a, b):
            found = starts[2][_bucket(_pair_hashes(hashes[a], hashes[b]))]
            return np.where((a > 0) & (b > 0), found, 0)

        yield from counted(3, lambda a, b, c: _both(pair_start(a, b), pair_start(b, c)))


def _packed(starts: dict[int, np.ndarray]) -> dict[int, bytes]:
    return {size: zlib.compress(flags.tobytes(), 1) for size, flags in starts.items()}


def _scanner(stop: int, shards: int, shared):
    """Task function of one stop: Arrow batches (lang, text) -> partial counts."""
    def counts(runs, starts, reading=None):
        """Counts of all runs; of the text being read the last words are left for the next run."""
        left = {}
        for lang, parts in runs.items():
            words, codes = _numbered(parts)
            most = len(codes)
            if lang == reading:
                most = max(0, most - LONGEST + 1)
                left[lang] = [words[int(c)].as_py() if c else MARK for c in codes[most:]]
            yield from _run_counts(words, codes, most, lang, stop, shards, starts)
        runs.clear()
        runs.update(left)

    def run(batches):
        starts = {size: np.frombuffer(zlib.decompress(flags), np.uint8) for size, flags in shared.value.items()}
        runs: dict[str, list[bytes]] = {}
        held = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for lang, text in zip(langs, texts):
                for part in _slices(text.as_py()):
                    runs.setdefault(lang, []).append(part)
                    held += len(part)
                    if held >= CHUNK:
                        yield from counts(runs, starts, lang)
                        held = 0
        yield from counts(runs, starts)
    return run


def scanned(docs: DataFrame, stop: int, shards: int, shared) -> DataFrame:
    """(key, size, start, count): what one stop counts of the phrases active in its shard.

    ``shared`` is a broadcast of the packed starts by size.
    """
    slots = 8 * (shards - 1) or 1
    shard = F.greatest(F.pmod(F.xxhash64("doc_id", "text"), F.lit(slots)) - (slots - shards), F.lit(0))
    texts = docs.filter(shard == stop % shards).select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(_scanner(stop, shards, shared), COUNTS) \
                .groupBy("key", "size", "start").agg(F.sum("count").alias("count"))


def _buckets(batches):
    """Arrow batches (key) -> (bucket) of words or pairs."""
    for batch in batches:
        out = []
        for key in batch.column(0).to_pylist():
            phrase, _, lang = key.partition("\t")
            h = _word_hashes(phrase.encode().split(b" "), lang)
            out.append(h if len(h) == 1 else _pair_hashes(h[:1], h[1:]))
        found = _bucket(np.concatenate(out)) if out else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["bucket"])


def _dense(part: pa.Table) -> pa.Table:
    buckets, flags = part["bucket"].to_numpy(), np.zeros(1 << PART_BITS, np.uint8)
    flags[buckets & (1 << PART_BITS) - 1] = 1
    return pa.table({"part": pa.array([int(buckets[0]) >> PART_BITS], pa.int64()),
                     "flags": pa.array([flags.tobytes()], pa.binary())})


def _started(keys: DataFrame, before: np.ndarray | None, start: int) -> np.ndarray | None:
    """``before`` with ``start`` in the buckets of ``keys`` that had none; None if there is no bucket yet.

    At most 2^(BUCKET_BITS - PART_BITS) rows of 2^PART_BITS bytes come to the driver.
    """
    found = keys.mapInArrow(_buckets, "bucket long").distinct() \
                .groupBy(F.shiftright("bucket", PART_BITS).alias("p")).applyInArrow(_dense, "part long, flags binary")
    rows = found.collect()
    if before is None and not rows:
        return None
    out = np.zeros(max(1 << BUCKET_BITS, 1 << PART_BITS), np.uint8) if before is None else before.copy()
    for r in rows:
        piece = out[r.part << PART_BITS:(r.part + 1) << PART_BITS]
        piece[(np.frombuffer(r.flags, np.uint8) == 1) & (piece == 0)] = start
    return out


def phrase_counts(docs: DataFrame, threshold: int = 10, shards: int = SHARDS) -> DataFrame:
    """(key, size, count): all words, and all phrases of up to three words counted ``threshold`` times or more."""
    starts: dict[int, np.ndarray] = {}
    still_open, complete = None, []
    for stop in range(LONGEST * shards):
        if stop >= shards and 1 not in starts or stop >= 2 * shards and 2 not in starts:
            break                              # no phrase is active any more
        needed = {size: flags for size, flags in starts.items() if stop < (size + 1) * shards}
        shared = docs.sparkSession.sparkContext.broadcast(_packed(needed))
        counts = scanned(docs, stop, shards, shared)
        if still_open is not None:
            counts = counts.unionByName(still_open).groupBy("key", "size", "start").agg(F.sum("count").alias("count"))
        last = F.col("start") + shards - 1
        counts = written(counts.filter((last > stop) | (F.col("size") == 1) | (F.col("count") >= threshold)),
                         f"phrases-{stop}")
        shared.destroy()                       # the stop's counts are written
        complete.append(counts.filter(last == stop))
        still_open = counts.filter(last > stop)
        for size in range(1, LONGEST):
            if stop < size * shards:           # later stops count no phrase of this size
                reached = counts.filter((F.col("count") >= threshold) & (F.col("size") == size)).select("key")
                found = _started(reached, starts.get(size), stop + 1)
                if found is not None:
                    starts[size] = found
    return reduce(DataFrame.unionByName, complete).drop("start")


def _phrase(key: Column) -> Column:
    return F.substring_index(key, "\t", 1)


def collocations(docs: DataFrame, threshold: int = 10, most: int = 2000, contained: int = 50,
                 shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, cut): each language's first ``most`` phrases.

    a phrase counted a times is cut where floor(10^6 a^2 / (l r)) is least; one that lies
    inside a longer phrase with at least ``contained`` percent of its count is left out.
    """
    counts = phrase_counts(docs, threshold, shards)
    lang = F.expr("substring(key, char_length(phrase) + 2)")
    named = counts.select("*", _phrase(F.col("key")).alias("phrase")).withColumn("lang", lang)
    total = named.filter("size = 1").groupBy("lang").agg(F.sum("count").alias("n"))
    often = written(named.filter(F.col("count") >= threshold), "often")
    rows = often.filter("size > 1").withColumn("words", F.split("phrase", " "))

    def part(start, length):
        return F.concat(F.array_join(F.slice("words", start, length), " "), F.lit("\t"), F.col("lang"))

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    cuts = rows.select("key", F.col("count").alias("a"), "size", "words", "lang", cut)
    cuts = cuts.select("key", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"),
                       part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest"))
    first, rest = (often.select(F.col("key").alias(name), F.col("count").alias(count))
                   for name, count in (("first", "l"), ("rest", "r")))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    scored = cuts.join(first, "first").join(rest, "rest").select(
        "key", "a", "cut", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * (exact("a") * exact("a"))).cast(EXACT)
        .alias("top"), (exact("l") * exact("r")).cast(EXACT).alias("under"))
    scored = scored.select("key", "a", F.struct(F.expr("top div under").alias("score"), "cut", "l", "r").alias("best")) \
                   .groupBy("key", "a").agg(F.min("best").alias("best"))

    span = F.explode(F.expr("flatten(transform(sequence(2, size - 1), "
                            "m -> transform(sequence(1, size - m + 1), i -> slice(words, i, m))))")).alias("inside")
    inside = rows.filter("size > 2").select("count", "lang", span) \
                 .select(F.concat(F.array_join("inside", " "), F.lit("\t"), "lang").alias("key"), "count") \
                 .groupBy("key").agg(F.max("count").alias("longer"))
    kept = scored.join(inside, "key", "left") \
                 .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained)) \
                 .select(_phrase(F.col("key")).alias("phrase"), "key", "a", "best.*").withColumn("lang", lang)

    # a language's rows are first thinned in SALTS parts, each of which may hold all of the winners
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part_of = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    part_of = part_of.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))) \
                     .filter(F.col("rank") <= most)
    ranked = part_of.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
                    .filter(F.col("rank") <= most)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
                                             "r", "n", F.col("score").cast("long").alias("score"),
                                             F.col("cut").cast("long").alias("cut"))
