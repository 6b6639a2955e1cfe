from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartflow.functions import (
    iso_text,
    month_of,
    rounded_mean,
    rounded_percent,
    rounded_ratio,
    to_whole,
    whole_days,
    whole_seconds,
)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("num", "den", "digits", "expected"),
    [
        (1, 2, 0, "1"),
        (-1, 2, 0, "-1"),
        (1, 8, 2, "0.13"),
        (-1, 8, 2, "-0.13"),
        (10, 3, 2, "3.33"),
        (20, 3, 2, "6.67"),
        (0, 7, 2, "0.00"),
        (1, 0, 2, None),
        (4_000_000_000_000_000_005, 10, 0, "400000000000000001"),
    ],
)
def test_rounded_ratio(spark, num, den, digits, expected):
    found = one(spark, rounded_ratio(F.lit(num), F.lit(den), digits))
    assert found == (None if expected is None else Decimal(expected))


def test_ratio_of_cents(spark):
    cents = F.lit(Decimal("10.50"))
    assert one(spark, rounded_ratio(F.lit(100), cents, 1, den_scale=2)) == Decimal("9.5")
    with pytest.raises(Exception, match="denominator is not a whole number: 10.50"):
        one(spark, rounded_ratio(F.lit(100), cents, 1))
    with pytest.raises(Exception, match="numerator is not a whole number"):
        one(spark, rounded_ratio(cents, F.lit(3), 1))


def test_mean_does_not_round_twice(spark):
    # 0.01 * 149999 / 300000 = 0.0049999.., which a mean cut to 6 digits would lift to 0.005.
    total, count = F.lit(Decimal("1499.99")).cast("decimal(20,2)"), F.lit(300000)
    assert one(spark, rounded_mean(total, count, 2, total_scale=2)) == Decimal("0.00")


def test_percent_may_exceed_hundred(spark):
    assert one(spark, rounded_percent(F.lit(7), F.lit(3))) == Decimal("233.33")


@pytest.mark.parametrize(("value", "expected"), [("2.50", 3), ("2.49", 2), ("-2.50", -3)])
def test_to_whole(spark, value, expected):
    assert one(spark, to_whole(F.lit(Decimal(value)))) == expected


@pytest.mark.parametrize(
    ("later", "earlier", "expected"),
    [
        ("2018-01-02 01:00:00", "2018-01-01 23:00:00", 0),
        ("2018-01-01 23:00:00", "2018-01-02 01:00:00", 0),
        ("2018-01-02 23:00:00", "2018-01-01 23:00:00", 1),
        ("2018-01-01 00:00:00", "2018-01-02 12:00:00", -1),
        ("2018-03-04 05:00:00", "2018-01-01 00:00:00", 62),
        (None, "2018-01-01 00:00:00", None),
    ],
)
def test_whole_days(spark, later, earlier, expected):
    days = whole_days(F.lit(later).cast("timestamp_ntz"), F.lit(earlier).cast("timestamp_ntz"))
    assert one(spark, days) == expected


@pytest.mark.parametrize(
    ("gap", "expected"), [("00:01:02.6", 63), ("00:01:02.4", 62), ("00:00:00.5", 1), ("23:59:59.5", 86400)]
)
def test_whole_seconds(spark, gap, expected):
    end, start = f"2020-02-01 {gap}", "2020-02-01 00:00:00"
    seconds = whole_seconds(F.lit(end).cast("timestamp_ntz"), F.lit(start).cast("timestamp_ntz"))
    assert one(spark, seconds) == expected


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # Local clocks skipped this hour.
        ts = F.lit("2017-10-15 00:30:00").cast("timestamp_ntz")
        assert one(spark, iso_text(ts)) == "2017-10-15T00:30:00"
        assert one(spark, month_of(ts)) == datetime(2017, 10, 1)
        before = F.lit("2017-10-14 23:30:00").cast("timestamp_ntz")
        assert one(spark, whole_seconds(ts, before)) == 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "moment", [datetime(2017, 1, 2, 3, 4, 5), datetime(2017, 1, 2, 3, 4, 5, 600), datetime(2017, 1, 2, 0, 0, 0, 500000)]
)
def test_iso_text(spark, moment):
    assert one(spark, iso_text(F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz"))) == moment.isoformat()


def test_iso_text_of_null(spark):
    assert one(spark, iso_text(F.lit(None).cast("timestamp_ntz"))) is None
