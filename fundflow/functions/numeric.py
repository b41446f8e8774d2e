"""Money and ratio arithmetic with one rounding rule everywhere.

Money stays DECIMAL so sums are exact whatever the row order.  Ratios are
DOUBLE: both operands are converted to double first and divided, then
rounded half away from zero at ``n`` places as ``round(x * 10^n) / 10^n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(38,2)"
REPORTED = "decimal(18,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(x, places: int) -> Column:
    scale = float(10 ** places)
    return F.round(_col(x).cast("double") * scale) / scale


def ratio(num, den) -> Column:
    """num / nullif(den, 0) as double (NULL when den is 0 or NULL)."""
    den = _col(den)
    return _col(num).cast("double") / F.nullif(den, F.lit(0)).cast("double")


def pct(num, den, places: int = 2) -> Column:
    return round_to(ratio(num, den) * 100, places)


def exact_avg(c, scale: int = 2) -> Column:
    """Average of a rounded double: exact decimal sum, one division.

    Summing doubles depends on row order; the values are already rounded to
    ``scale`` places, so summing them as decimals is exact and deterministic.
    """
    d = _col(c).cast(f"decimal(20,{scale})")
    return F.sum(d).cast("double") / F.nullif(F.count(d), F.lit(0))
