"""Exact money rounding.

``round(avg(double), 2)`` differs between engines at half cents because the
double sum is order dependent.  Summing whole cents as integers is exact and
order independent; half-up rounding of ``s / n`` to a cent is then
``(2*s + n) div (2*n)`` for a non-negative ``s`` (sign handled explicitly).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleanse import as_col


def cents(c) -> Column:
    """Amount -> whole cents (half away from zero), as a long."""
    return F.round(as_col(c) * F.lit(100)).cast("long")


def _half_up_div(s: Column, n: Column) -> Column:
    # integer division (SQL ``div``) keeps the arithmetic exact in longs
    mag = F.call_function("div", F.abs(s) * 2 + n, n * 2)
    return F.when(s < 0, -mag).otherwise(mag)


def round_avg_cents(sum_cents: Column, n: Column) -> Column:
    """Average of cents rounded half-up to a cent, returned in currency units."""
    return _half_up_div(sum_cents, n) / F.lit(100)
