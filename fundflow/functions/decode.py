"""Code decoding, refund flags, size buckets and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Code -> label tables of the bulk filings.  A code that is not
# listed falls through to the table's default (None = keep the raw code).
# ---------------------------------------------------------------------------
PARTY = {"DEM": "Democrat", "REP": "Republican", "IND": "Independent",
         "LIB": "Libertarian", "GRE": "Green"}
PARTY_DEFAULT = "Other / Unknown"

OFFICE = {"P": "President", "S": "Senate", "H": "House"}

INCUMBENCY = {"I": "Incumbent", "C": "Challenger", "O": "Open Seat"}
INCUMBENCY_DEFAULT = "Unknown"

CANDIDATE_STATUS = {"C": "Statutory Candidate",
                    "F": "Statutory Candidate (future election)",
                    "N": "Not Yet Statutory Candidate",
                    "P": "Statutory Candidate (prior cycle)"}

COMMITTEE_DESIGNATION = {"A": "Authorized by Candidate", "B": "Lobbyist/Registrant PAC",
                         "D": "Leadership PAC", "J": "Joint Fundraiser",
                         "P": "Principal Campaign Committee", "U": "Unauthorized"}

COMMITTEE_TYPE = {
    "C": "Communication Cost", "D": "Delegate", "E": "Electioneering Communication",
    "H": "House", "I": "Independent Expenditor (Person or Group)",
    "N": "PAC - Nonqualified", "O": "Super PAC (Independent Expenditure-Only)",
    "P": "Presidential", "Q": "PAC - Qualified", "S": "Senate",
    "U": "Single Candidate Independent Expenditure",
    "V": "PAC with Non-Contribution Account - Nonqualified",
    "W": "PAC with Non-Contribution Account - Qualified",
    "X": "Party - Nonqualified", "Y": "Party - Qualified",
    "Z": "National Party Nonfederal Account",
}
SUPER_PAC_TYPE = "O"

ORGANIZATION_TYPE = {"C": "Corporation", "L": "Labor Organization",
                     "M": "Membership Organization", "T": "Trade Association",
                     "V": "Cooperative", "W": "Corporation w/o Capital Stock"}
ORGANIZATION_DEFAULT = "Unknown / Individual"

LINKAGE_DESIGNATION = {"P": "Principal Campaign Committee", "A": "Authorized by Candidate",
                       "D": "Leadership PAC", "J": "Joint Fundraiser"}

# Donation size buckets: refund first, then <200, 200-999, 1000-2999, >=3000.
# Amounts strictly between 999 and 1000 or 2999 and 3000 fall in no bucket.
SMALL_BELOW = 200
MEDIUM_RANGE = (200, 999)
LARGE_RANGE = (1000, 2999)
MAJOR_FROM = 3000
REFUND_TYPE_PREFIX = "22"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c, mapping: dict[str, str], default: str | None = None) -> Column:
    """CASE c WHEN k THEN v ... ELSE default (or c itself) END."""
    c = _col(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(c == code, F.lit(label)) if expr is None
                else expr.when(c == code, F.lit(label)))
    return expr.otherwise(c if default is None else F.lit(default))


def is_refund(transaction_type, amount) -> Column:
    """Three-valued: NULL type with a non-negative amount gives NULL."""
    return _col(transaction_type).startswith(REFUND_TYPE_PREFIX) | (_col(amount) < 0)


def size_bucket(refund, amount) -> Column:
    a = _col(amount)
    return (F.when(_col(refund), F.lit("refund"))
            .when(a < SMALL_BELOW, F.lit("small"))
            .when(a.between(*MEDIUM_RANGE), F.lit("medium"))
            .when(a.between(*LARGE_RANGE), F.lit("large"))
            .when(a >= MAJOR_FROM, F.lit("major")))


def filing_date(c, lenient: bool = False) -> Column:
    """MMDDYYYY text -> date when the text has 8 characters, else NULL.

    An impossible date (month 13) fails the query, as in the source;
    ``lenient=True`` turns it into NULL instead.
    """
    c = _col(c)
    parse = F.try_to_date(c, "MMddyyyy") if lenient else F.to_date(c, "MMddyyyy")
    return F.when(F.length(c) == 8, parse)


def report_end_timestamp(c) -> Column:
    """M/D/YYYY text -> timestamp (no zone); blank or invalid -> NULL."""
    t = F.nullif(F.trim(_col(c)), F.lit(""))
    return F.try_to_timestamp(t, F.lit("M/d/yyyy")).cast("timestamp_ntz")
