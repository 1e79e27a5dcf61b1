"""Numeric column helpers.

Rounding follows numpy (``rint`` on the scaled value, ties to even), not
Spark's ``round`` (half up).  Prices are handled as integer cents where
exact sums matter, so window sums are order-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def np_round(x, digits: int) -> Column:
    """numpy-style round: rint(x * 10^d) / 10^d (half to even)."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def to_cents(x, scale: int = 2) -> Column:
    """Price -> integer minor units (exact for prices quoted at ``scale`` dp)."""
    return F.round(_c(x) * F.lit(float(10 ** scale))).cast("long")


def safe_div(num, den) -> Column:
    """Division that yields null for a zero or null divisor (never raises)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
