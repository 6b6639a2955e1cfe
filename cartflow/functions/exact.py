"""Exact rounding of ratios, half away from zero.

``avg`` and ``/`` on Spark decimals round to a limited scale first, so rounding
their result again can be off by one in the last digit. The helpers below work
on whole numbers instead. They are meant for aggregate outputs: a few decimal
operations per group, none per input row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"


def _whole(value: Column, name: str) -> Column:
    """The value as a whole number; a fraction fails instead of being rounded."""
    whole = value.cast(WHOLE)
    return F.when(value.isNull() | (value % 1 == 0), whole).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), value.cast("string"))).cast(WHOLE)
    )


def rounded_ratio(num: Column, den: Column, digits: int, den_scale: int = 0) -> Column:
    """``num / den`` rounded to ``digits`` places; NULL when ``den`` is 0 or NULL.

    ``num`` must hold whole numbers, ``den`` at most ``den_scale`` decimal places, which are checked, and must not
    be negative.
    """
    scale, unit = 10**digits, 10**den_scale
    n = _whole(num, "numerator") * F.lit(unit) if den_scale else _whole(num, "numerator")
    d = _whole(den * F.lit(unit) if den_scale else den, "denominator")
    steps = F.call_function("div", F.abs(n) * F.lit(2 * scale) + d, d * F.lit(2))
    signed = F.when(n < 0, -steps).otherwise(steps)
    value = (signed.cast("decimal(20,0)") / F.lit(scale)).cast(f"decimal(20,{digits})")
    return F.when(d != 0, value)


def rounded_percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded to ``digits`` places."""
    return rounded_ratio(part.cast(WHOLE) * F.lit(100), whole, digits)


def rounded_mean(total: Column, count: Column, digits: int, total_scale: int = 0) -> Column:
    """Mean from a sum holding at most ``total_scale`` decimal places."""
    unit = 10**total_scale
    if total_scale == 0:
        return rounded_ratio(total, count, digits)
    return rounded_ratio(total * F.lit(unit), count.cast(WHOLE) * F.lit(unit), digits)


def to_whole(value: Column) -> Column:
    """Round a decimal to the nearest whole number, half away from zero."""
    return F.round(value, 0)
