"""Name and employer normalisation as Column expressions (JVM-side, codegen).

``initcap`` capitalises the first letter after each space and lowers the
rest, which is exactly "split on space, capitalise each word, join" once runs
of spaces are collapsed.  Hyphens, apostrophes and tabs are not word breaks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Corporate suffixes stripped (one, at the end, any case, with
# an optional dot) from employer and connected-organisation names.
# ---------------------------------------------------------------------------
CORPORATE_SUFFIXES = ["Inc", "Llc", "Corp", "Ltd", "Co", "Lp", "Llp", "Na", "Pc", "Plc"]

_SUFFIX_PATTERN = r"(?i)\s+(" + "|".join(s + r"\.?" for s in CORPORATE_SUFFIXES) + r")$"


def _null_text() -> Column:
    return F.lit(None).cast("string")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Trim, collapse spaces, capitalise each word; blank or NULL -> NULL."""
    t = F.trim(_col(c))
    return F.when(t.isNull() | (t == ""), _null_text()).otherwise(
        F.initcap(F.regexp_replace(t, " +", " ")))


def normalize_name(c) -> Column:
    return title_case(c)


def normalize_employer(c) -> Column:
    """Title case, '&' -> ' And ', strip one trailing corporate suffix.

    Unlike ``title_case`` a blank value stays '' (not NULL).
    """
    s = F.initcap(F.regexp_replace(F.lower(F.trim(_col(c))), r"\s+", " "))
    s = F.regexp_replace(s, r"\s*&\s*", " And ")
    return F.regexp_replace(s, _SUFFIX_PATTERN, "")


def _part(c: Column, i: int) -> Column:
    return F.trim(F.split_part(c, F.lit(","), F.lit(i)))


def candidate_last_name(c) -> Column:
    c = _col(c)
    return F.when(F.instr(c, ",") > 0, title_case(_part(c, 1))).otherwise(title_case(c))


def candidate_first_name(c) -> Column:
    c = _col(c)
    return F.when(F.instr(c, ",") > 0, title_case(_part(c, 2))).otherwise(_null_text())


def candidate_display_name(c) -> Column:
    """'LAST, FIRST' -> 'First Last'; NULL when either part is blank."""
    c = _col(c)
    both = F.concat(title_case(_part(c, 2)), F.lit(" "), title_case(_part(c, 1)))
    return F.when(F.instr(c, ",") > 0, both).otherwise(title_case(c))
