"""Dates and times. Everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NANOS_PER_DAY = 86_400_000_000_000

# Fixed value: the quote feed's time format, with optional fractional seconds.
QUOTE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]X"


def epoch_nanos_to_date(nanos: Column) -> Column:
    """UTC date of an epoch-nanosecond value, in integer arithmetic: a double cannot hold
    19 digits, and the result must not depend on the session time zone."""
    day = F.lit(NANOS_PER_DAY)
    days = F.call_function("div", nanos - F.pmod(nanos, day), day)
    return F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int"))


def previous_weekday(day: Column) -> Column:
    """The same day Monday to Friday; the Friday before on a weekend."""
    return F.date_sub(day, F.greatest(F.weekday(day) - F.lit(4), F.lit(0)))


def parse_quote_time(text: Column) -> Column:
    """ISO time to timestamp; NULL (not an error) when the text has another form."""
    return F.try_to_timestamp(text, F.lit(QUOTE_TIME_FORMAT))
