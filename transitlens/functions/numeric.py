"""Exact rounding helpers.

Averages are computed from integer sums so that results do not depend on
the order in which partial sums meet (which differs with partitioning), and
so that ``ROUND(x, 2)`` means decimal half-up rounding, as in the warehouse
the reference ran on, instead of rounding a binary double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a, b) -> Column:
    """Integer division (SQL ``div``), exact for bigint."""
    return F.call_function("div", _c(a), _c(b))


def round_div_int(num, den) -> Column:
    """round(num / den) half away from zero for integers; null if den is 0/null."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    q = idiv(F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    return F.when(d != 0, signed)


def cents_of_ratio(num, den, scale: int = 1) -> Column:
    """round(100 * num / (scale * den)) for num, den >= 0, as bigint hundredths.

    ``scale`` lets the numerator be in finer units (e.g. seconds with
    scale=3600 for hours). Null when den is 0 or null.
    """
    return round_div_int(_c(num).cast("bigint") * 100, _c(den).cast("bigint") * scale)


def from_cents(c) -> Column:
    return _c(c) / F.lit(100.0)


def ratio2(num, den, scale: int = 1) -> Column:
    """ROUND(num / (scale*den), 2) as double, NULL when den = 0 (NULLIF form)."""
    return from_cents(cents_of_ratio(num, den, scale))


def pct2(part, whole) -> Column:
    """ROUND(100 * part / whole, 2) as double."""
    return from_cents(round_div_int(_c(part).cast("bigint") * 10000, whole))
