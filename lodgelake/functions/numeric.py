"""Numeric helpers.

Money is kept as exact decimals or integer cents.  Ratios that are reported
rounded use :func:`ratio_half_up`, which rounds the exact rational half away
from zero with integer arithmetic, so no binary floating-point error can move a
value across a rounding boundary (1.005 stays 1.01).  Unrounded ratios use one
IEEE division of two exact operands (:func:`exact_quotient`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def clean_price(c: Column) -> Column:
    """'$1,234.50' -> 1234.50; empty or malformed text ('1.2.3') -> NULL."""
    return F.regexp_replace(c.cast("string"), r"[^0-9.]", "").try_cast("decimal(18,2)")


def cents(price: Column) -> Column:
    """Exact integer cents of a decimal(18,2) price."""
    return (price * 100).cast("bigint")


def stays_30(availability_30: Column) -> Column:
    """Booked nights of the next 30 days; no upper clamp (marts)."""
    return F.greatest(F.lit(0), 30 - F.coalesce(availability_30, F.lit(0)))


def stays_30_clamped(availability_30: Column) -> Column:
    """Booked nights clamped to [0, 30] (analyses)."""
    return F.greatest(F.lit(0), F.least(F.lit(30), 30 - F.coalesce(availability_30, F.lit(0))))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL."""
    return num / F.nullif(den, F.lit(0))


def exact_quotient(num: Column, den: Column) -> Column:
    """One double division of two exact integers; NULL when den is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def ratio_half_up(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale), half away from zero, for integer num and den > 0.

    Computed as sign(n) * floor((2|n| + d) / 2d) with n = num * 10^scale,
    entirely in 38-digit decimals, then scaled back to a double.
    NULL when den is 0 or NULL.
    """
    k = 10 ** scale
    n = num.cast(_WIDE) * F.lit(k).cast(_WIDE)
    d = den.cast(_WIDE)
    a = F.abs(n) * 2 + d
    b = d * 2
    q = ((a - F.pmod(a, b)) / b).cast("bigint")
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d > 0, signed.cast("double") / k)


def round_cents_half_up(cents_value: Column) -> Column:
    """A cent amount that may end in .5 (a median) -> dollars rounded half up."""
    return F.floor(cents_value + 0.5).cast("double") / 100


def pct_change_rounded(cur: Column, prev: Column, scale: int = 2) -> Column:
    """100 * (cur - prev) / prev rounded; NULL when prev is NULL or 0."""
    return F.when(prev.isNotNull() & (prev != 0), ratio_half_up((cur - prev) * 100, prev, scale))


def pct_change_exact(cur: Column, prev: Column) -> Column:
    """100 * (cur - prev) / prev unrounded; NULL when prev is NULL or 0."""
    return F.when(prev.isNotNull() & (prev != 0), exact_quotient((cur - prev) * 100, prev))
