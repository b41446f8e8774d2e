"""Connected components of a large sparse graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (src, dst) with src > dst -> every neighbour linked to the node's least neighbour.

    The large star links a node's larger neighbours, the small star its smaller
    ones and itself.  The minimum is pre-aggregated map-side and joined back,
    so AQE can split a hub's rows over many tasks.
    """
    if small:
        near = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    else:
        near = edges.select(F.inline(F.array(
            F.struct(F.col("src").alias("u"), F.col("dst").alias("v")),
            F.struct(F.col("dst").alias("u"), F.col("src").alias("v")))))
    least = near.groupBy("u").agg(F.min("v").alias("m")) \
                .select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    linked = near.join(least, F.col("u") == F.col("c"))
    if small:
        to = linked.select(F.inline(F.array(
            F.struct(F.col("v").alias("src"), F.col("m").alias("dst")),
            F.struct(F.col("u").alias("src"), F.col("m").alias("dst")))))
    else:
        to = linked.filter(F.col("v") > F.col("u")) \
                   .select(F.col("v").alias("src"), F.col("m").alias("dst"))
    return to.filter("src != dst").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): every node that has an edge, with the least node it can reach.

    ``edges`` has two long columns; direction, repeats and loops don't matter.
    Each round is written to shared storage, so a lost executor costs one round.
    """
    pair = edges.toDF("a", "b").filter("a != b")
    now = written(pair.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
                      .distinct(), name)
    mark = _mark(now)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        now = written(_star(_star(now, small=False), small=True), name)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of an edge set (32-bit parts, so sums can't overflow)."""
    h = F.xxhash64("src", "dst")
    row = edges.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))),
                    F.sum(F.shiftrightunsigned(h, 32))).first()
    return tuple(row)
