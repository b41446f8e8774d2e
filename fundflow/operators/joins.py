"""Join helpers.

Which side of a join is broadcast is left to the planner: it knows the bytes of
the Parquet it reads, and AQE the bytes that a stage really wrote
(``spark.sql.autoBroadcastJoinThreshold``).  Larger sides are sort-merge joined, and
AQE splits a hot key over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    cond = None
    for lcol, rcol in pairs:
        c = left[lcol].eqNullSafe(right[rcol])
        cond = c if cond is None else cond & c
    return cond
