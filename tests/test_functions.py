from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barweave.functions.arrays import last_value, mean, prepend
from barweave.functions.calendar import epoch_nanos_to_date, parse_quote_time, previous_weekday
from barweave.functions.market_cap import market_cap_bucket
from barweave.functions.prices import (
    absolute_change,
    adjust_price,
    adjust_volume,
    percent_change,
)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "cap, bucket",
    [
        (None, "Not Provided"),
        (float("nan"), "Not Provided"),
        (200e9, "Large Cap"),
        (200e9 + 1, "Mega Cap"),
        (10e9, "Mid Cap"),
        (2e9, "Small Cap"),
        (250e6, "Micro Cap"),
        (250e6 + 1, "Small Cap"),
        (0.0, "Micro Cap"),
        (-5.0, "Micro Cap"),
    ],
)
def test_market_cap_bounds_are_exclusive(spark, cap, bucket):
    assert value(spark, market_cap_bucket(F.lit(cap).cast("double"))) == bucket


@pytest.mark.parametrize(
    "on, expected",
    [
        ("2000-06-15", "2000-06-15"),
        ("2000-06-16", "2000-06-16"),
        ("2000-06-17", "2000-06-16"),
        ("2000-06-18", "2000-06-16"),
        ("2000-06-19", "2000-06-19"),
    ],
)
def test_previous_weekday(spark, on, expected):
    assert str(value(spark, previous_weekday(F.lit(on).cast("date")))) == expected


def test_epoch_nanos_keep_the_utc_date_in_any_time_zone(spark):
    last_nano = 86_400_000_000_000 * 11_000 - 1
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            read = value(spark, epoch_nanos_to_date(F.lit(last_nano)).cast("string"))
            assert read == "2000-02-12"
            after = value(spark, epoch_nanos_to_date(F.lit(last_nano + 1)).cast("string"))
            assert after == "2000-02-13"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_epoch_nanos_before_1970(spark):
    assert value(spark, epoch_nanos_to_date(F.lit(-1).cast("bigint"))) == date(1969, 12, 31)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-06-26T15:59:00Z", datetime(2024, 6, 26, 15, 59)),
        ("2024-06-26T15:59:00.25Z", datetime(2024, 6, 26, 15, 59, 0, 250_000)),
        ("2024-06-26T15:59:00.123456789Z", datetime(2024, 6, 26, 15, 59, 0, 123_456)),
        ("2024-06-26T11:59:00-04", datetime(2024, 6, 26, 15, 59)),
        ("2024", None),
        ("soon", None),
        (None, None),
    ],
)
def test_quote_times(spark, text, expected):
    parsed = parse_quote_time(F.lit(text).cast("string")).cast("timestamp_ntz")
    assert value(spark, parsed) == expected


def test_adjustment_moves_price_and_volume_in_opposite_directions(spark):
    one, ten = F.lit(1.0), F.lit(10.0)
    assert value(spark, adjust_price(F.lit(1200.0), one, ten)) == 120.0
    assert value(spark, adjust_volume(F.lit(7.0), one, ten)) == 70.0
    none = F.lit(None).cast("double")
    assert value(spark, adjust_price(F.lit(3.14159), none, none)) == 3.1416


def test_changes(spark):
    none = F.lit(None).cast("double")
    assert value(spark, absolute_change(F.lit(3.0), F.lit(0.0))) == 3.0
    assert value(spark, absolute_change(F.lit(3.0), none)) is None
    assert value(spark, percent_change(F.lit(3.0), F.lit(0.0))) is None
    assert value(spark, percent_change(F.lit(3.0), none)) is None
    assert value(spark, percent_change(F.lit(1.0), F.lit(3.0))) == -66.67


def test_array_reductions(spark):
    empty = F.array().cast("array<double>")
    values = F.array(F.lit(3.0), F.lit(1.0), F.lit(2.0))
    assert value(spark, mean(values)) == 2.0
    assert value(spark, mean(empty)) is None
    assert value(spark, mean(F.array(F.lit(1.0), F.lit(None)))) is None
    assert value(spark, last_value(values)) == 2.0
    assert value(spark, last_value(empty)) is None


def test_prepend_with_missing_sides(spark):
    none, some = F.lit(None).cast("array<int>"), F.array(F.lit(1))
    assert value(spark, prepend(none, some)) == [1]
    assert value(spark, prepend(some, none)) == [1]
    assert value(spark, prepend(F.array(F.lit(2)), some)) == [2, 1]
    assert value(spark, prepend(none, none)) is None
