"""Derived-feature column expressions."""

import math

from pyspark.sql import functions as F

# The characters Unicode counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

REFERENCE_DATE = "2025-09-21"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def strip(c):
    """Trim all Unicode white space, not only U+0020."""
    return F.btrim(_col(c), F.lit(WHITE_SPACE))


def ward_and_province(location):
    """(ward, province) of ``"ward, province"``: split at the first comma, both trimmed."""
    parts = F.split(_col(location), ",", 2)
    return strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))


def area_key(ward, province):
    return F.concat(F.coalesce(_col(ward), F.lit("Unknown")), F.lit(" | "), F.coalesce(_col(province), F.lit("Unknown")))


def listed_at(hours, reference=REFERENCE_DATE):
    """The moment ``hours`` before the reference date; NULL hours give NULL."""
    return F.lit(reference).cast("timestamp_ntz") - F.make_dt_interval(hours=_col(hours).cast("int"))


def date_parts(ts):
    ts = _col(ts)
    return F.dayofmonth(ts), F.month(ts), F.year(ts)


def month_start(year, month):
    return F.make_date(_col(year), _col(month), F.lit(1))


def cyclic_day(day, month, year):
    """Sine and cosine of the day within its month's length."""
    length = F.dayofmonth(F.last_day(month_start(year, month)))
    angle = F.lit(2 * math.pi) * _col(day) / length
    return F.sin(angle), F.cos(angle)


def cyclic_month(month):
    angle = F.lit(2 * math.pi) * _col(month) / F.lit(12)
    return F.sin(angle), F.cos(angle)


def ratio(a, b):
    """a / b; a zero denominator gives NULL, where pandas would give infinity."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def flag(c):
    """Boolean to 0/1 with NULL as 0."""
    return F.coalesce(_col(c), F.lit(False)).cast("int")


def at_least(c, minimum):
    """The larger of the value and the minimum; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(minimum)))


def non_negative(c):
    c = _col(c)
    return F.when(c >= 0, c)


def nan_to_null(c):
    c = _col(c)
    return F.when(~F.isnan(c), c)


def quantile_segment(c, q1, q3, missing="High"):
    """Low up to q1, Mid up to q3, else High. A missing value falls through to ``missing``."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(missing)).when(c <= q1, "Low").when(c <= q3, "Mid").otherwise("High")


def cut(c, edges, labels):
    """Label of the half-open interval (edges[i], edges[i+1]] holding the value, else NULL."""
    c = _col(c)
    branch = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        test = (c > lo) & (c <= hi)
        branch = F.when(test, label) if branch is None else branch.when(test, label)
    return branch


def largest_column(columns):
    """Name of the first column that holds the largest value of the row, ignoring NULLs."""
    # the largest is computed once, not once for each column
    cells = F.array(*[F.col(f"`{c}`") for c in columns])
    return F.get(F.lit(list(columns)), F.array_position(cells, F.array_max(cells)).cast("int") - 1)
