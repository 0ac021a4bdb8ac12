"""String helpers shared by all operators (pure Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space set trimmed by Go's strings.TrimSpace
# (ASCII \t \n \v \f \r and space, NEL, NBSP, and the Unicode White_Space code points).
GO_SPACE_CLASS = r"[\t\n\x0B\f\r \u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _edge_space(c: Column) -> Column:
    """First or last character is white space: a constant-time test on the two end characters,
    so long values that need no trimming never reach a regular expression."""
    return F.substring(c, 1, 1).rlike(GO_SPACE_CLASS) | F.substring(c, -1, 1).rlike(GO_SPACE_CLASS)


def go_trim(c) -> Column:
    """Trim leading and trailing Unicode white space (Spark's trim only removes blanks)."""
    c = col_(c)
    trimmed = F.regexp_replace(F.regexp_replace(c, rf"^{GO_SPACE_CLASS}+", ""), rf"{GO_SPACE_CLASS}+\z", "")
    return F.when(_edge_space(c), trimmed).otherwise(c)


def is_blank(c) -> Column:
    """True when the value is null or only white space (first character checked first)."""
    c = col_(c)
    return c.isNull() | (F.length(c) == 0) | (F.substring(c, 1, 1).rlike(GO_SPACE_CLASS) & c.rlike(rf"^{GO_SPACE_CLASS}+\z"))


def nz(c, default="") -> Column:
    return F.coalesce(col_(c), F.lit(default))


def safe_div(num, den) -> Column:
    """num / den, 0.0 when den is 0 or null (the reference reports zero rates on empty input)."""
    num, den = col_(num), col_(den)
    return F.when(F.coalesce(den, F.lit(0)) == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def wall_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp (TIMESTAMP_NTZ event times),
    independent of the session time zone, so elapsed times never shift across DST changes."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col_(c).cast("timestamp_ntz"))
