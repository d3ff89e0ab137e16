"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a, b) -> Column:
    """Exact integer floor division of two non-negative long columns."""
    a = _col(a).cast("long")
    b = _col(b).cast("long")
    return ((a - F.pmod(a, b)) / b).cast("long")


def ratio_half_up(numerator, denominator, scale: int = 2) -> Column:
    """``numerator / denominator`` rounded half-up to ``scale`` decimals, as a double.

    Both inputs are integer counts, so the rounding is done in exact integer
    arithmetic: ``(2*10^s*n + d) div (2*d) / 10^s``.  This avoids the binary
    representation trap (29/200 is 0.145 exactly but 0.14499.. as a double)
    and gives the same answer in any SQL engine.  A zero or null denominator
    gives null.
    """
    n = _col(numerator).cast("long")
    d = _col(denominator).cast("long")
    p = 10 ** scale
    return F.when(d != 0, int_div(n * (2 * p) + d, d * 2) / F.lit(float(p)))
