"""Exact ratios.  Everything is decimal: a double would round 1.005 differently per engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, times: int = 1) -> Column:
    """``times * part / whole`` to two places (halves away from zero); NULL when whole is 0.

    The divisor keeps two places.  26.2 digits over 14.2 leave 12 places in the quotient, so
    the second rounding is exact for every divisor below 10^7.
    """
    top = (part if times == 1 else part * F.lit(times)).cast("decimal(26,2)")
    bottom = whole.cast("decimal(14,2)")
    return F.round(top / F.nullif(bottom, F.lit(0).cast("decimal(14,2)")), 2).cast("decimal(26,2)")
