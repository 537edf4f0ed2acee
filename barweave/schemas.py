"""Explicit schemas of every source and table.

No reader infers a schema: an explicit ``double`` field also turns the JSON
number ``1`` into ``1.0``, so integer-valued prices never become longs.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

STRING, LONG, DOUBLE = StringType(), LongType(), DoubleType()
BOOLEAN, DATE, TIMESTAMP = BooleanType(), DateType(), TimestampType()

# Fixed field order of one array element.
BAR_FIELDS = ["volume", "open", "close", "high", "low", "transactions", "snapshot_date"]

# Calendar days one array covers, the newest day included.
WINDOW_DAYS = 365


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def without(schema: StructType, column: str) -> StructType:
    return StructType([field for field in schema if field.name != column])


_BAR_COLUMNS = {
    "ticker": STRING,
    "volume": LONG,
    "open": DOUBLE,
    "close": DOUBLE,
    "high": DOUBLE,
    "low": DOUBLE,
    "window_start": LONG,
    "transactions": LONG,
}

BAR_CSV = _struct(**_BAR_COLUMNS)

BARS = _struct(**_BAR_COLUMNS, snapshot_date=DATE)

BARS_BY_MONTH = _struct(**_BAR_COLUMNS, snapshot_date=DATE, month=DATE)

PRICE_ELEMENT = _struct(
    volume=DOUBLE,
    open=DOUBLE,
    close=DOUBLE,
    high=DOUBLE,
    low=DOUBLE,
    transactions=LONG,
    snapshot_date=DATE,
)

CUMULATIVE = _struct(ticker=STRING, price_array=ArrayType(PRICE_ELEMENT), as_of_date=DATE)

_SPLIT_COLUMNS = {
    "execution_date": STRING,
    "split_from": DOUBLE,
    "split_to": DOUBLE,
    "ticker": STRING,
}

SPLITS = _struct(**_SPLIT_COLUMNS, as_of_date=DATE)

# ``id`` and ``withdrawn`` may be missing, as may the page's own ``url`` and its ``count``.
SPLIT_PAGE = _struct(
    status=STRING,
    url=STRING,
    next_url=STRING,
    count=LONG,
    results=ArrayType(_struct(id=STRING, **_SPLIT_COLUMNS, withdrawn=BOOLEAN)),
)

# Where something stood in the feed, in the order of arrival.
ARRIVAL = _struct(day=DATE, modified=TIMESTAMP, path=STRING, place=LONG)

# What one claim about a split says, when that was first and last said.
SPLIT_LEDGER = _struct(
    claim=STRING,
    **_SPLIT_COLUMNS,
    withdrawn=BOOLEAN,
    seen=ARRIVAL,
    told=ARRIVAL,
    as_of_date=DATE,
)

# Files of a feed that were read, and their pages.
FEED_FILES = _struct(
    path=STRING, modified=TIMESTAMP, length=LONG, address=STRING, wanted=STRING, as_of_date=DATE
)

DIM_PRICES = _struct(
    ticker=STRING,
    close_price_last_day=DOUBLE,
    close_price_avg_last_90_days=DOUBLE,
    close_price_avg_last_365_days=DOUBLE,
    as_of_date=DATE,
)

TICKER_DOCUMENT = _struct(
    results=_struct(
        ticker=STRING,
        ticker_root=STRING,
        name=STRING,
        active=BOOLEAN,
        currency_name=STRING,
        locale=STRING,
        market=STRING,
        market_cap=DOUBLE,
        primary_exchange=STRING,
        sic_description=STRING,
        weighted_shares_outstanding=DOUBLE,
    )
)

TICKER_DETAILS = _struct(
    ticker=STRING,
    ticker_root=STRING,
    company_name=STRING,
    is_actively_traded=BOOLEAN,
    currency_name=STRING,
    country=STRING,
    asset_type=STRING,
    market_cap=DOUBLE,
    primary_exchange=STRING,
    industry_description=STRING,
    weighted_shares_outstanding=DOUBLE,
    market_cap_description=STRING,
    as_of_date=DATE,
)

ASSET = _struct(symbol=STRING, status=STRING)

QUOTE_PAGE = _struct(
    status=STRING,
    bars=MapType(
        STRING,
        _struct(
            c=DOUBLE, h=DOUBLE, l=DOUBLE, n=LONG, o=DOUBLE, t=STRING, v=LONG, vw=DOUBLE
        ),
    ),
    next_page_token=STRING,
)

# Reference price -> the two metrics measured against it.
METRICS = {
    "close_price_last_day": ("m_price_change_last_day", "m_price_change_last_day_pct"),
    "close_price_avg_last_90_days": (
        "m_price_change_last_90_days",
        "m_price_change_last_90_days_pct",
    ),
    "close_price_avg_last_365_days": (
        "m_price_change_last_365_days",
        "m_price_change_last_365_days_pct",
    ),
}

METRIC_COLUMNS = [name for pair in METRICS.values() for name in pair]

# The columns an intraday update overwrites; everything else is left alone.
UPDATED_COLUMNS = ["current_price", "last_updated_datetime", *METRIC_COLUMNS]

CURRENT_DAY = _struct(
    ticker=STRING,
    **{base: DOUBLE for base in METRICS},
    current_price=DOUBLE,
    **{name: DOUBLE for name in METRIC_COLUMNS},
    market_cap_description=STRING,
    last_updated_datetime=TIMESTAMP,
)

# When a quote landed, in the order that ``last_write_wins`` follows; stored beside the prices.
QUOTE_ARRIVAL = _struct(modified=TIMESTAMP, path=STRING, place=LONG)

CURRENT_DAY_ARRIVED = StructType([*CURRENT_DAY, StructField("arrival", QUOTE_ARRIVAL)])
