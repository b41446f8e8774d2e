"""Best row per key: ``row_number() OVER (PARTITION BY k ORDER BY o) = 1``.

Catalyst plans the ``= 1`` filter as a *partial* ``WindowGroupLimit`` that
keeps one row per key in every map task before the shuffle, and a final one
after it.  A key holding a third of the rows is therefore cut down to one row
per mapper first, like a map-side combine.  The whole row is appended to the
ordering so the choice is total and reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """One row per ``keys``: the first row in ``order`` (then by all columns)."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    tie_break = [F.col(c).asc_nulls_last() for c in df.columns]
    w = Window.partitionBy(*key_cols).orderBy(*order, *tie_break)
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))
