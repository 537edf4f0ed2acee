"""Price arithmetic: split adjustment and change metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADJUSTED_DIGITS = 4
METRIC_DIGITS = 2


def adjust_price(price: Column, split_from: Column, split_to: Column) -> Column:
    """Price in post-split shares; a missing factor counts as 1."""
    one = F.lit(1.0)
    return F.round(
        price * F.coalesce(split_from, one) / F.coalesce(split_to, one), ADJUSTED_DIGITS
    )


def adjust_volume(volume: Column, split_from: Column, split_to: Column) -> Column:
    """Volume moves the opposite way to the price, and may become fractional."""
    return adjust_price(volume, split_to, split_from)


def absolute_change(current: Column, base: Column) -> Column:
    return F.round(current - base, METRIC_DIGITS)


def percent_change(current: Column, base: Column) -> Column:
    """NULL when the base is missing or zero."""
    usable = base.isNotNull() & (base != 0)
    return F.when(usable, F.round(F.lit(100) * (current - base) / base, METRIC_DIGITS))
