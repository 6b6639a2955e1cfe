"""Time expressions over ``timestamp_ntz`` columns.

None goes through a zoned timestamp, so the session time zone cannot shift a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24 h periods between two timestamps, cut toward zero."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two timestamps, rounded half away from zero."""
    gap = later - earlier
    seconds = F.extract(F.lit("SECOND"), gap)
    for unit, length in (("MINUTE", 60), ("HOUR", 3600), ("DAY", 86400)):
        seconds = seconds + F.extract(F.lit(unit), gap) * F.lit(length)
    return F.round(seconds, 0).cast("int")


def month_of(ts: Column) -> Column:
    """First instant of the month."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    """ISO-8601 text; a fraction is written, with six digits, only when it is not zero."""
    text = ts.cast("string")
    base = F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T"))
    fraction = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.when(F.length(text) <= 19, base).otherwise(F.concat(base, F.lit("."), fraction))
