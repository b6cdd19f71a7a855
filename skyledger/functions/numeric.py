"""Numeric expressions whose NULL, NaN and rounding rules must hold in every operator.

Spark treats NaN as the largest double and lets ``least``/``greatest`` skip NULLs. The weather
tables need IEEE comparisons (any comparison with NaN is false) and NULL in, NULL out, so
operators use these helpers instead of the bare functions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above this size a double has no second decimal left to round.
_NO_CENTS_LEFT = 4.5e13


def round2(value: Column) -> Column:
    """Round half away from zero to two decimals; NULL, NaN and infinities pass through.

    ``F.round`` goes through a decimal and breaks ties differently from double arithmetic.
    Adding 0.0 turns a possible -0.0 into 0.0.
    """
    size = F.abs(value)
    rounded = F.signum(value) * (F.floor(size * 100.0 + 0.5) / 100.0) + 0.0
    return F.when(size < _NO_CENTS_LEFT, rounded).otherwise(value)


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Limit to [low, high]; NULL stays NULL and NaN stays NaN."""
    return F.when(value < low, F.lit(low)).when(is_above(value, high), F.lit(high)).otherwise(value)


def is_above(value: Column, bound: Column | float) -> Column:
    """``value > bound`` where NaN is never above anything."""
    return (value > bound) & ~F.isnan(value)


def is_at_least(value: Column, bound: Column | float) -> Column:
    """``value >= bound`` where NaN is never at least anything."""
    return (value >= bound) & ~F.isnan(value)


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, NULL when ``whole`` is zero, rounded to two decimals."""
    return round2(F.try_divide(part, whole) * 100.0)
