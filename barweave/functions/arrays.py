"""Expressions over one ticker's array of daily bars.

Each runs inside a projection: no explode, no shuffle, no regrouping.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import BAR_FIELDS
from .prices import adjust_price, adjust_volume

PRICE_FIELDS = ["open", "close", "high", "low"]


def element(**fields: Column) -> Column:
    """One bar in the stored field order."""
    return F.struct(*[fields[name].alias(name) for name in BAR_FIELDS])


def bar_row(volume: str = "volume") -> Column:
    """Struct of a flat bar's columns, the date first so that sorting sorts by date."""
    rest = [name for name in BAR_FIELDS if name not in ("snapshot_date", "volume")]
    return F.struct("snapshot_date", F.col(volume).cast("double").alias("volume"), *rest)


def newest_first(rows: Column) -> Column:
    """Collected ``bar_row`` structs -> ordered array. Collecting alone has no order."""
    return F.transform(
        F.sort_array(rows, asc=False),
        lambda bar: element(**{name: bar[name] for name in BAR_FIELDS}),
    )


def keep_after(array: Column, cutoff: Column) -> Column:
    return F.filter(array, lambda bar: bar["snapshot_date"] > cutoff)


def adjust_bar(bar: Column, split_from: Column, split_to: Column) -> Column:
    prices = {name: adjust_price(bar[name], split_from, split_to) for name in PRICE_FIELDS}
    return element(
        volume=adjust_volume(bar["volume"], split_from, split_to),
        transactions=bar["transactions"],
        snapshot_date=bar["snapshot_date"],
        **prices,
    )


def prepend(newer: Column, older: Column) -> Column:
    """Concatenate two arrays, either of which may be missing."""
    return (
        F.when(older.isNull(), newer).when(newer.isNull(), older).otherwise(F.concat(newer, older))
    )


def last_value(values: Column) -> Column:
    """Last element, NULL when there is none."""
    return F.aggregate(values, F.lit(None).cast("double"), lambda _, value: value)


def mean(values: Column) -> Column:
    """Mean in array order; NULL when empty and, unlike AVG, when any value is NULL."""
    return F.aggregate(
        values,
        F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
        lambda state, value: F.struct(
            (state["total"] + value).alias("total"), (state["n"] + 1).alias("n")
        ),
        lambda state: F.when(state["n"] > 0, state["total"] / state["n"]),
    )
