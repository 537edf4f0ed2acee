from __future__ import annotations

import os
import sys
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barweave.schemas import BARS, CUMULATIVE, SPLITS  # noqa: E402
from barweave.session import local_session  # noqa: E402

TEST_DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_DATA


def day(text: str) -> date:
    return date.fromisoformat(text)


def nanos(on: date) -> int:
    return (on - date(1970, 1, 1)).days * 86_400_000_000_000 + 14_400_000_000_000


@pytest.fixture
def make_bars(spark):
    """Rows of (ticker, date text, close); the other fields follow from the close."""

    def make(*rows, **overrides):
        data = []
        for ticker, on, close in rows:
            bar = {
                "ticker": ticker, "volume": 100, "open": close, "close": close, "high": close,
                "low": close, "window_start": nanos(day(on)), "transactions": 5,
                "snapshot_date": day(on),
            }
            bar.update(overrides)
            data.append(tuple(bar[name] for name in BARS.fieldNames()))
        return spark.createDataFrame(data, BARS)

    return make


@pytest.fixture
def make_splits(spark):
    """Rows of (ticker, date text, from, to); loaded on their execution date."""

    def make(*rows):
        data = [(on, float(a), float(b), ticker, day(on)) for ticker, on, a, b in rows]
        return spark.createDataFrame(data, SPLITS)

    return make


@pytest.fixture
def make_arrays(spark):
    """Rows of (ticker, as-of text, [(date text, close), ...] or None)."""

    def make(*rows):
        data = []
        for ticker, as_of, bars in rows:
            array = bars and [(100.0, c, c, c, c, 5, day(on)) for on, c in bars]
            data.append((ticker, [] if bars == [] else array, day(as_of)))
        return spark.createDataFrame(data, CUMULATIVE)

    return make


def closes(frame) -> dict:
    """ticker -> [(date text, close), ...] in array order, or None."""
    return {
        row["ticker"]: None
        if row["price_array"] is None
        else [(str(bar["snapshot_date"]), bar["close"]) for bar in row["price_array"]]
        for row in frame.collect()
    }
