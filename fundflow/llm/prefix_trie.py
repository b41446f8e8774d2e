"""Conversation prefix trie, by collapsing whole sequences.

A node is a distinct sequence of first turns (role, text); its members are the conversations
that begin with it.  The trie is not built top-down, turn by turn:

1. Every turn becomes a 16-byte digest and a word count before anything is shuffled, and a
   running digest along each conversation names all its prefixes.
2. Identical conversations collapse into one weighted sequence with its least conv_id and
   its list of ends.
3. Sequences that are a proper prefix of another go by an anti-join; those left are the leaves.
4. The prefixes of the weighted sequences are aggregated into nodes.

A node belongs to the sequence of its smallest member.  What a sequence owns is the end of
its path, so a sum over a node's subtree is the sum, over the sequences through it, of what
they own from there on: one running sum along each path, linear in its length.

Skew: copies of one conversation collapse in a map-side aggregate; the root and frequent
first turns are map-side aggregates too, and rows joined to them are plain joins that AQE
splits.  End lists are sorted and cut to chunks over all tasks; only the digest itself runs
along one list, as SHA-256 must, and holds a chunk at a time.  A long conversation is one
task's stream, never one row.

Cases: null role or text is the empty string; a null turn comes first; rows of one turn
number follow the order of their digests, repeated rows are turns of their own; rows without
a conv_id belong to no conversation; a conversation rebuilt without turns is a member of the root;
an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words_of, written

CHUNK_IDS = 16_384
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that name a turn (128 bits of SHA-256)."""
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): the turns of each conversation in order, from 1."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", turn_digest(role, text).alias("digest"),
        F.size(words_of(text)).alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, pos, digest, words): conversation c begins with the first h turns of its group's first.

    h is crc32(c) % heads and the group's first conversation c - c % group; then come
    c's own turns after its first h.  Every conversation also has a row of position 0.
    """
    turns = written(turns, "trie-turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = turns.filter("pos = 1").select("conv_id", base.alias("base"), head.alias("h"))
    first = turns.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "base")
    lent = convs.filter("base != conv_id").join(first, "base").filter("pos <= h") \
                .select("conv_id", "pos", "digest", "words")
    own = turns.filter((base == F.col("conv_id")) | (F.col("pos") > head))
    start = convs.select("conv_id", F.lit(0).alias("pos"), F.lit(b"").alias("digest"),
                         F.lit(0).alias("words"))
    return start.unionByName(lent).unionByName(own)


def _chain(batches):
    """Rows (conv_id, pos, digest, words) in order -> every prefix, named by a running digest.

    One row is held back, as only the next one tells whether it ends its conversation.
    """
    conv = held = running = key = None
    depth = 0
    for batch in batches:
        out = []
        for c, digest, words in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(),
                                    batch.column(3).to_pylist()):
            if held is not None:
                out.append((*held, c != conv))
            if c != conv:
                conv, running, depth, parent = c, hashlib.sha256(), 0, None
            else:
                depth, parent = depth + 1, key
                running.update(digest)
            key = running.digest()[:16]
            held = (c, depth, key, parent, words)
        yield _rows(out)
    if held is not None:
        yield _rows([(*held, True)])


_PATHS = "conv_id long, depth int, key binary, parent binary, words int, last boolean"
_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("key", pa.binary()),
                    ("parent", pa.binary()), ("words", pa.int32()), ("last", pa.bool_())])


def _rows(rows: list[tuple]):
    columns = zip(*rows) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words, last): a row per conversation and prefix, the root's first."""
    rows = turns.select(F.col("conv_id").cast("long"), "pos", "digest", "words") \
                .repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return rows.mapInArrow(_chain, _PATHS)


def _chunks(batches):
    """Rows (key, conv_id) in order -> (key, first, ids): runs of a key's ids, joined by commas."""
    for batch in batches:
        keys, ids, out = batch.column(0).to_pylist(), batch.column(1).to_pylist(), []
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start] or i - start == CHUNK_IDS:
                out.append((keys[start], ids[start], ",".join(map(str, ids[start:i]))))
                start = i
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))],
                names=["key", "first", "ids"])


def _hashed(batches):
    """Chunks (key, first, ids) in order -> (key, ends_sha256)."""
    key = running = None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2)):
            if k != key:
                if key is not None:
                    out.append((key, running.hexdigest()))
                key, running = k, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.as_buffer())
        if out:
            yield _digests(out)
    if key is not None:
        yield _digests([(key, running.hexdigest())])


def _digests(rows):
    keys, values = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.string())],
                                      names=["key", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids, ascending and joined by commas."""
    chunks = ends.select("key", "conv_id").repartitionByRange("key", "conv_id") \
                 .sortWithinPartitions("key", "conv_id") \
                 .mapInArrow(_chunks, "key binary, first long, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first") \
                 .mapInArrow(_hashed, "key binary, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """One row per node of conversations given as (conv_id, pos, digest, words), position 0 included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, key): see the module's text; ``saved_tokens`` counts the words that a
    prefix cache saves within the node's subtree.
    """
    paths = written(prefixes(turns), "trie-paths")
    ends = paths.filter("last")
    sequences = ends.groupBy("key").agg(F.min("conv_id").alias("conv_id"),
                                        F.count(F.lit(1)).alias("weight"))
    inner = paths.filter("not last").select("key").distinct()
    leaves = sequences.join(inner, "key", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weighted = sequences.drop("key").join(leaves, "conv_id", "left").na.fill(0, ["leaf"])
    steps = written(paths.drop("last").join(weighted, "conv_id"), "trie-steps")

    nodes = written(steps.groupBy("key", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves")), "trie-nodes")

    own = nodes.select("key", "conv_id", ((F.col("n_convs") - 1)).alias("again"))
    onward = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()) \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.coalesce(F.col("again") * F.col("words"), F.lit(0)).cast("long")
    saved = steps.join(own, ["key", "conv_id"], "left") \
                 .select("key", F.sum(value).over(onward).alias("value")) \
                 .groupBy("key").agg(F.sum("value").alias("saved_tokens"))

    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")) \
                    .agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(saved, "key").join(children, "key", "left").join(end_digests(ends), "key", "left") \
               .join(above, "parent", "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs",
                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "key")
