"""Exact decimal arithmetic for rounded averages and ratios.

PostgreSQL's numeric averages are exact and ``round`` goes half away
from zero.  Dividing decimals in Spark rounds once at the division scale
and again at ``round``; integer arithmetic on scaled units avoids the
double rounding and gives the same result as the exact value.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_units(c: Column, scale: int) -> Column:
    """Decimal value → integer count of 10^-scale units (DECIMAL(38,0))."""
    return (c * F.lit(10 ** scale)).cast("decimal(38,0)")


def half_up_ratio(num_units: Column, den: Column, scale: int) -> Column:
    """round(num_units / den, scale) half away from zero, where the
    numerator is already in 10^-scale units.  NULL when ``den`` is 0 or
    NULL.  Result: DECIMAL(38, scale)."""
    n = num_units.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    x, y = (F.abs(n) * 2 + d).cast("decimal(38,0)"), (d * 2).cast("decimal(38,0)")
    q = (x - x % y) / y             # a whole number: the division does not round
    signed = F.when(n < 0, -q).otherwise(q)
    return F.when(d > 0, (signed.cast("decimal(38,0)") / F.lit(10 ** scale))
                  .cast(f"decimal(38,{scale})"))
