"""Bars staged month by month, and history from files."""

import gzip
import json
import os
from datetime import date, timedelta

import pytest
from conftest import closes, day, nanos

from barweave.operators.checks import DataQualityError
from barweave.plans import daily
from barweave.plans.daily import Feeds, Tables, run_day, stage_months, staged_bars, start_from_files
from barweave.schemas import BAR_CSV, BARS_BY_MONTH
from barweave.sources.tables import newest_date, partition_dates

JUNE = date(2000, 6, 1)
MONTHS = [date(2000, 4, 1), date(2000, 5, 1), JUNE]


def write_day(root, on, *tickers, close=10.0, dated=None):
    folder = root / f"bars/{on:%Y/%m}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [f"{t},100,{close},{close},{close},{close},{nanos(dated or on)},5" for t in tickers]
    with gzip.open(folder / f"{on}.csv.gz", "wt") as file:
        file.write("\n".join([",".join(BAR_CSV.fieldNames()), *lines]) + "\n")


@pytest.fixture
def landed(spark, tmp_path):
    for month in MONTHS:
        for offset in (2, 8):
            write_day(tmp_path, month + timedelta(days=offset), "A", "B")
    return Tables(str(tmp_path / "tables")), Feeds(str(tmp_path / "bars"), str(tmp_path / "splits"))


def rows(spark, tables, first=MONTHS[0], last=JUNE + timedelta(days=29)):
    return sorted((r["ticker"], r["snapshot_date"], r["close"]) for r in staged_bars(spark, tables, first, last).collect())


def test_staging_goes_on_after_a_lost_driver(spark, landed, monkeypatch):
    tables, feeds = landed
    real, calls = daily.publish_partition, []

    def lost(*arguments, **options):
        calls.append(arguments[3])
        if len(calls) == 2:
            raise KeyboardInterrupt
        return real(*arguments, **options)

    with monkeypatch.context() as patched:
        patched.setattr(daily, "publish_partition", lost)
        with pytest.raises(KeyboardInterrupt):
            stage_months(spark, tables, feeds.bars, MONTHS)
    assert partition_dates(spark, tables.staged_months, "month") == MONTHS[:1]
    assert stage_months(spark, tables, feeds.bars, MONTHS) == MONTHS[1:]
    assert stage_months(spark, tables, feeds.bars, MONTHS) == []
    assert len(rows(spark, tables)) == 12


def test_one_month_is_replaced(spark, tmp_path, landed):
    tables, feeds = landed
    stage_months(spark, tables, feeds.bars, MONTHS)
    write_day(tmp_path, date(2000, 5, 3), "A", close=7.0)
    assert stage_months(spark, tables, feeds.bars, MONTHS[1:2], again=True) == MONTHS[1:2]
    found = rows(spark, tables)
    assert len(found) == 11 and ("A", date(2000, 5, 3), 7.0) in found


def test_a_bar_of_another_month_stages_nothing(spark, tmp_path, landed):
    tables, feeds = landed
    write_day(tmp_path, date(2000, 5, 20), "A", dated=date(2000, 6, 20))
    with pytest.raises(DataQualityError, match="snapshot_date_is_in_month_check"):
        stage_months(spark, tables, feeds.bars, MONTHS)
    assert partition_dates(spark, tables.staged_months, "month") == MONTHS[:1]


def test_only_the_months_asked_for_are_read(spark, landed):
    tables, feeds = landed
    stage_months(spark, tables, feeds.bars, MONTHS)
    bars = staged_bars(spark, tables, date(2000, 5, 4), date(2000, 5, 31))
    assert all("month=2000-05-01" in file for file in bars.inputFiles())
    assert sorted(r["ticker"] for r in bars.collect()) == ["A", "B"]


def test_the_newest_day_is_found_in_the_newest_month(spark, tmp_path, landed):
    tables, feeds = landed
    july = date(2000, 7, 1)
    write_day(tmp_path, july)  # a file without a bar
    stage_months(spark, tables, feeds.bars, [*MONTHS, july])
    newest = newest_date(spark, tables.staged_months, BARS_BY_MONTH, "snapshot_date", "month")
    assert newest == date(2000, 6, 9)
    assert newest_date(spark, tables.staged_months, BARS_BY_MONTH, "month", "month") == july
    assert newest_date(spark, f"{tmp_path}/none", BARS_BY_MONTH, "month", "month") is None
    # Partition names alone: no data file is opened, however broken.
    for folder, _, files in os.walk(tables.staged_months):
        for name in files:
            if name.endswith(".parquet"):
                with open(f"{folder}/{name}", "w") as file:
                    file.write("torn")
    assert newest_date(spark, tables.staged_months, BARS_BY_MONTH, "month", "month") == july


def test_history_from_files_and_on(spark, tmp_path, landed):
    tables, feeds = landed
    on, eve = date(2000, 6, 12), date(2000, 6, 9)
    for month in range(1, 13):  # the months before have files without a bar
        first = date(1999 if month > 5 else 2000, month, 1)
        if first not in MONTHS:
            write_day(tmp_path, first)
    (tmp_path / "splits").mkdir()
    results = [{"ticker": "A", "execution_date": "2000-05-03", "split_from": 1, "split_to": 5}]
    (tmp_path / "splits/1.json").write_text(json.dumps({"status": "OK", "results": results}))
    for _ in range(2):
        start_from_files(spark, tables, feeds, on - timedelta(days=1))
    arrays = closes(tables.arrays_of(spark, on - timedelta(days=1)))
    assert arrays["A"] == [
        (str(eve), 10.0), ("2000-06-03", 10.0), ("2000-05-09", 10.0), ("2000-05-03", 10.0),
        ("2000-04-09", 2.0), ("2000-04-03", 2.0),
    ]
    write_day(tmp_path, on, "A", "B", close=11.0)
    run_day(spark, tables, feeds, on)
    assert closes(tables.arrays_of(spark, on))["A"] == [(str(on), 11.0), *arrays["A"]]
    assert day("2000-06-12") == on
