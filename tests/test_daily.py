"""The whole daily load, on files."""

import gzip
import json
from datetime import date, timedelta

import pytest
from conftest import closes, nanos

from barweave.operators.checks import DataQualityError
from barweave.operators.leaderboard import leaderboard
from barweave.plans.daily import Feeds, Tables, load_details, run_day, run_days, start_history
from barweave.schemas import BAR_CSV, DIM_PRICES, SPLITS
from barweave.sources.json_feeds import stream_quotes
from barweave.sources.tables import read_table
from barweave.streaming.current_day import read_current, start_day, start_updates

EVE = date(2000, 6, 14)  # a Wednesday; EVE + 3 and EVE + 4 are the weekend
TICKERS = [f"T{i:03d}" for i in range(200)]


def at(offset):
    return EVE + timedelta(days=offset)


def write_day(root, on, tickers=TICKERS, close=10.0, splits=(), extra=()):
    folder = root / f"bars/{on:%Y/%m}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{t},100,{close},{close},{close},{close},{nanos(on)},5" for t in tickers]
    with gzip.open(folder / f"{on}.csv.gz", "wt") as file:
        file.write("\n".join([",".join(BAR_CSV.fieldNames()), *lines, *extra]) + "\n")
    pages = root / "splits"
    pages.mkdir(exist_ok=True)
    results = [
        {"ticker": t, "execution_date": str(on), "split_from": a, "split_to": b}
        for t, a, b in splits
    ]
    (pages / f"{on}.json").write_text(json.dumps({"status": "OK", "results": results}))


@pytest.fixture(params=[None, 4], ids=["plain", "bucketed"])
def load(request, spark, tmp_path, make_bars, make_splits):
    tables = Tables(str(tmp_path / "tables"), buckets=request.param)
    feeds = Feeds(str(tmp_path / "bars"), str(tmp_path / "splits"))
    bars = make_bars(*[(ticker, str(EVE), 10.0) for ticker in TICKERS])
    start_history(tables, bars, make_splits(), EVE)
    return tables, feeds


def page(root, name, *splits):
    results = [
        {"ticker": t, "execution_date": str(on), "split_from": a, "split_to": b}
        for t, on, a, b in splits
    ]
    (root / f"splits/{name}.json").write_text(json.dumps({"status": "OK", "results": results}))


def test_a_late_split_is_applied_once_and_recorded(spark, tmp_path, load):
    tables, feeds = load
    write_day(tmp_path, at(1), close=10.0)
    run_days(spark, tables, feeds, at(1), at(1))
    page(tmp_path, "late", ("T000", EVE, 1, 2), ("T001", at(1), 1, 5))
    write_day(tmp_path, at(2), close=12.0, splits=[("T002", 1, 4)])
    for _ in range(2):  # running the day again changes nothing
        run_day(spark, tables, feeds, at(2))
    arrays = closes(tables.arrays_of(spark, at(2)))
    # Bars on the day of a split, and after it, are in its terms already.
    assert arrays["T000"] == [(str(at(2)), 12.0), (str(at(1)), 10.0), (str(EVE), 10.0)]
    assert arrays["T001"] == [(str(at(2)), 12.0), (str(at(1)), 10.0), (str(EVE), 2.0)]
    assert arrays["T002"] == [(str(at(2)), 12.0), (str(at(1)), 2.5), (str(EVE), 2.5)]
    run_days(spark, tables, feeds, at(3), at(4))
    assert closes(tables.arrays_of(spark, at(4))) == arrays
    recorded = read_table(spark, tables.splits, SPLITS).collect()
    found = sorted((r["ticker"], r["execution_date"], r["as_of_date"]) for r in recorded)
    assert found == [
        ("T000", str(EVE), at(2)), ("T001", str(at(1)), at(2)), ("T002", str(at(2)), at(2))
    ]


def test_a_split_of_the_backfill_is_not_late(spark, tmp_path, make_bars, make_splits):
    tables = Tables(str(tmp_path / "tables"))
    feeds = Feeds(str(tmp_path / "bars"), str(tmp_path / "splits"))
    bars = make_bars(*[(t, str(on), 10.0) for t in TICKERS for on in (at(-1), EVE)])
    start_history(tables, bars, make_splits(("T000", str(EVE), 1, 2)), EVE)
    write_day(tmp_path, at(1), close=10.0)
    page(tmp_path, "all", ("T000", EVE, 1, 2))
    run_days(spark, tables, feeds, at(1), at(1))
    arrays = closes(tables.arrays_of(spark, at(1)))
    assert arrays["T000"] == [(str(at(1)), 10.0), (str(EVE), 10.0), (str(at(-1)), 5.0)]


def test_a_day_without_a_record_of_splits_is_refused(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"))
    feeds = Feeds(str(tmp_path / "bars"), str(tmp_path / "splits"))
    write_day(tmp_path, at(1))
    with pytest.raises(ValueError, match="no record"):
        run_day(spark, tables, feeds, at(1))


def test_catch_up_over_a_weekend(spark, tmp_path, load):
    tables, feeds = load
    write_day(tmp_path, at(1), close=10.0)
    write_day(tmp_path, at(2), close=12.0, splits=[("T000", 1, 2)])
    run_days(spark, tables, feeds, at(1), at(4))
    arrays = closes(tables.arrays_of(spark, at(4)))
    assert len(arrays) == len(TICKERS)
    assert arrays["T001"] == [(str(at(2)), 12.0), (str(at(1)), 10.0), (str(EVE), 10.0)]
    assert arrays["T000"] == [(str(at(2)), 12.0), (str(at(1)), 5.0), (str(EVE), 5.0)]
    prices = read_table(spark, tables.prices, DIM_PRICES)
    sunday = {r["ticker"]: r for r in prices.filter(prices.as_of_date == at(4)).collect()}
    assert sunday["T001"]["close_price_last_day"] == 12.0
    assert prices.count() == 4 * len(TICKERS)
    assert read_table(spark, tables.splits, SPLITS).count() == 1


def test_running_a_day_again_changes_nothing(spark, tmp_path, load):
    tables, feeds = load
    write_day(tmp_path, at(1), splits=[("T000", 1, 2)])
    run_day(spark, tables, feeds, at(1))
    once = closes(tables.arrays_of(spark, at(1)))
    run_day(spark, tables, feeds, at(1))
    assert closes(tables.arrays_of(spark, at(1))) == once
    assert read_table(spark, tables.splits, SPLITS).count() == 1


def test_too_many_new_tickers_publish_nothing(spark, tmp_path, load):
    tables, feeds = load
    write_day(tmp_path, at(1))
    run_day(spark, tables, feeds, at(1))
    before = closes(tables.arrays_of(spark, at(1)))
    write_day(tmp_path, at(1), tickers=[*TICKERS, "X1", "X2"], close=99.0)
    with pytest.raises(DataQualityError, match="new_rows_under_threshold_check"):
        run_day(spark, tables, feeds, at(1))
    assert closes(tables.arrays_of(spark, at(1))) == before


@pytest.mark.parametrize(
    "line, check",
    [
        (f"T999,100,1,,1,1,{nanos(at(1))},5", "close_is_not_null_check"),
        (f"T000,100,1,1,1,1,{nanos(at(1))},5", "bars_are_unique_check"),
        (f"T999,100,1,1,1,1,{nanos(EVE)},5", "snapshot_date_is_day_check"),
    ],
)
def test_bad_bars_stop_the_day(spark, tmp_path, load, line, check):
    tables, feeds = load
    write_day(tmp_path, at(1), extra=[line])
    with pytest.raises(DataQualityError, match=check):
        run_day(spark, tables, feeds, at(1))


def test_bad_splits_stop_the_day_before_they_are_published(spark, tmp_path, load):
    tables, feeds = load
    write_day(tmp_path, at(1), splits=[("T000", 0, 2)])
    with pytest.raises(DataQualityError, match="split_from_is_positive_check"):
        run_day(spark, tables, feeds, at(1))


def test_from_files_to_leaderboard(spark, tmp_path, load):
    """The daily load, the details, a day of quotes, and the board over them."""
    tables, feeds = load
    write_day(tmp_path, at(1), close=10.0)
    run_day(spark, tables, feeds, at(1))
    details = tmp_path / "details"
    details.mkdir()
    for name, cap in (("T000", 5e9), ("T001", 5e11)):
        document = {"results": {"ticker": name, "market": "stocks", "market_cap": cap}}
        (details / f"{name}.json").write_text(json.dumps(document))
    (details / "missing.json").write_text(json.dumps({"status": "NOT_FOUND"}))
    for _ in range(2):
        load_details(spark, tables, str(details), at(0))
    start_day(spark, tables, at(1))

    polls = tmp_path / "quotes"
    polls.mkdir()
    bars = {name: {"c": 10 + i, "t": "2000-06-16T14:00:00Z"} for i, name in enumerate(TICKERS)}
    (polls / "page.json").write_text(json.dumps({"bars": bars}))
    feed = stream_quotes(spark, str(polls))
    start_updates(feed, tables.current, str(tmp_path / "checkpoint")).awaitTermination()

    current = read_current(spark, tables.current)
    assert current.count() == len(TICKERS)
    board = leaderboard(current, "m_price_change_last_day_pct", ascending=False)
    rows = [tuple(row) for row in board.collect()]
    assert len(rows) == 50 and rows[0] == ("T199", 1990.0)
    mid = leaderboard(current, "m_price_change_last_day_pct", False, caps=["Mid Cap"])
    assert [tuple(row) for row in mid.collect()] == [("T000", 0.0)]
    assert current.filter("market_cap_description = 'Not Provided'").count() == len(TICKERS) - 2
