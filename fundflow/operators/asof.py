"""As-of join: each left row with the latest right row of its key that is not later.

Neither side is expanded.  The left side is cut down to its distinct (key, time) pairs and the
right side to one row per (key, time), both map-side first; the two are put on one
time line per key, and a running ``last`` carries the right rows forward.  The answer, one row per
(key, time), is joined back to the left rows as a plain equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import best_per_key
from .joins import null_safe_on


def as_of_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], time: tuple[str, str],
               columns: list[str], order: list[Column] = ()) -> DataFrame:
    """``left`` plus ``columns`` of the right row with equal keys and the greatest time <= the left row's.

    Columns without such a row are null.  Null keys and null times match nothing.  Of several
    right rows of one time the first in ``order`` (then by all columns) is taken.  ``columns`` must not
    occur in ``left``.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    on_line = F.col("_at").isNotNull()
    for name in names:
        on_line = on_line & F.col(name).isNotNull()
    asked = left.select(*[F.col(k).alias(n) for (k, _), n in zip(keys, names)], F.col(time[0]).alias("_at")) \
                .filter(on_line).distinct()
    told = best_per_key(right, [k for _, k in keys] + [time[1]], list(order)).select(
        *[F.col(k).alias(n) for (_, k), n in zip(keys, names)], F.col(time[1]).alias("_at"),
        F.struct(*columns).alias("_row")).filter(on_line)
    line = asked.withColumn("_row", F.lit(None).cast(told.schema["_row"].dataType)).withColumn("_asks", F.lit(1)) \
                .unionByName(told.withColumn("_asks", F.lit(0)))
    upto = Window.partitionBy(*names).orderBy("_at", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    answers = line.withColumn("_row", F.last("_row", ignorenulls=True).over(upto)) \
                  .filter("_asks = 1").drop("_asks")
    pairs = [(k, n) for (k, _), n in zip(keys, names)] + [(time[0], "_at")]
    joined = left.join(answers, null_safe_on(left, answers, pairs), "left")
    return joined.select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in columns])
