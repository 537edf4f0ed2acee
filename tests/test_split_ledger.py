"""Splits by identity: re-landed, corrected and withdrawn ones, whole page chains, new files only."""

import itertools
import json
import os
import random
import shutil
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from barweave.operators.checks import DataQualityError
from barweave.operators.split_events import active_splits, changed_ratios, merge_events, split_events
from barweave.plans.daily import Feeds, Tables, _new_splits, read_new_splits, start_history
from barweave.schemas import FEED_FILES, SPLIT_LEDGER, SPLITS
from barweave.sinks.tables import publish_partition
from barweave.sources.json_feeds import read_quotes, read_split_pages, read_splits
from barweave.sources.landed import landed_files, new_files
from barweave.sources.tables import partition_dates, read_newest_partition, read_partition

EVE = date(2000, 6, 14)


def at(offset):
    return EVE + timedelta(days=offset)


def result(ticker, on, a, b, **more):
    return {"ticker": ticker, "execution_date": str(on), "split_from": a, "split_to": b, **more}


class Landing:
    """Pages with rising times, as files land."""

    def __init__(self, root):
        self.root, self.time = root, 1_000_000_000
        root.mkdir()

    def page(self, name, *results, **envelope):
        self.text(name, json.dumps({"status": "OK", "results": list(results), **envelope}, indent=1))

    def text(self, name, text):
        (self.root / name).write_text(text)
        self.time += 60
        os.utime(self.root / name, (self.time, self.time))


@pytest.fixture
def feed(spark, tmp_path, make_bars, make_splits):
    """A started history of one ticker, its feed, and the splits that a day applies."""
    landing = Landing(tmp_path / "splits")
    tables = Tables(str(tmp_path / "tables"))
    feeds = Feeds(str(tmp_path / "bars"), str(landing.root))
    start_history(tables, make_bars(("A", str(EVE), 8.0)), make_splits(), EVE)

    def load(offset):
        read_new_splits(spark, tables, feeds, at(offset))
        publish_partition(_new_splits(spark, tables, at(offset)), tables.splits, SPLITS, at(offset))
        rows = read_partition(spark, tables.splits, SPLITS, at(offset)).collect()
        return sorted((r["ticker"], r["execution_date"], r["split_from"], r["split_to"]) for r in rows)

    return landing, load, tables


def test_a_page_landed_again_changes_nothing(feed):
    landing, load, _ = feed
    landing.page("one.json", result("A", EVE, 1, 10), result("B", at(1), 1, 2))
    landing.page("copy.json", result("A", EVE, 1, 10), result("B", at(1), 1, 2))
    assert load(1) == [("A", str(EVE), 1.0, 10.0), ("B", str(at(1)), 1.0, 2.0)]
    landing.page("later.json", result("A", EVE, 1, 10), result("B", at(1), 1.0, 2))
    assert load(2) == []
    assert load(2) == []


def test_a_correction_by_id_replaces(feed):
    landing, load, _ = feed
    landing.page("1.json", result("A", EVE, 1, 10, id="x"))
    assert load(1) == [("A", str(EVE), 1.0, 10.0)]
    landing.page("2.json", result("A", EVE, 1, 5, id="x"))
    assert load(2) == [("A", str(EVE), 10.0, 5.0)]
    # The first page once more, and the correction once more: neither is new.
    landing.page("3.json", result("A", EVE, 1, 10, id="x"))
    landing.page("4.json", result("A", EVE, 1, 5, id="x"))
    assert load(3) == []
    landing.page("5.json", result("A", at(2), 1, 5, id="x"))
    assert load(4) == [("A", str(EVE), 5.0, 1.0), ("A", str(at(2)), 1.0, 5.0)]


def test_a_withdrawal_is_taken_back_by_the_inverse(feed):
    landing, load, _ = feed
    landing.page("1.json", result("A", EVE, 1, 10), result("B", EVE, 1, 3, id="b"))
    assert len(load(1)) == 2
    landing.page("2.json", result("A", EVE, 1, 10, withdrawn=True), result("B", None, None, None, id="b", withdrawn=True))
    assert load(2) == [("A", str(EVE), 10.0, 1.0), ("B", str(EVE), 3.0, 1.0)]
    landing.page("1-again.json", result("A", EVE, 1, 10), result("B", EVE, 1, 3, id="b"))
    assert load(3) == []


def test_a_file_written_anew_takes_back_what_it_no_longer_says(feed):
    landing, load, _ = feed
    landing.page("1.json", result("A", EVE, 1, 10), result("B", EVE, 1, 3))
    assert len(load(1)) == 2
    landing.page("1.json", result("A", EVE, 1, 10))
    assert load(2) == [("B", str(EVE), 3.0, 1.0)]
    landing.page("1.json", result("A", EVE, 1, 4), result("C", at(3), 1, 3))
    assert load(3) == [("A", str(EVE), 10.0, 4.0), ("C", str(at(3)), 1.0, 3.0)]


def test_what_a_later_file_says_is_not_taken_back(feed):
    landing, load, _ = feed
    landing.page("1.json", result("A", EVE, 1, 10))
    landing.page("2.json", result("A", EVE, 1, 10))
    assert len(load(1)) == 1
    landing.page("1.json")
    assert load(2) == []


def test_an_event_with_and_without_id_is_one(feed, make_splits):
    landing, load, _ = feed
    landing.page("1.json", result("A", EVE, 1, 10, id="x"), result("A", EVE, 1, 10))
    landing.page("2.json", result("A", EVE, 1, 10, id="y"), result("A", EVE, 1, 2))
    assert load(1) == [("A", str(EVE), 1.0, 20.0)]


def test_any_order_and_any_repetition_is_one_state(spark, tmp_path):
    """Pages of distinct events, dealt over days in every order, with copies."""
    pages = [[result("A", EVE, 1, 10)], [result("A", EVE, 1, 2), result("B", EVE, 1, 3)], [result("C", EVE, 2, 1)]]
    rng = random.Random(1)
    found = set()
    for number, order in enumerate(itertools.permutations(pages)):
        landing = Landing(tmp_path / f"f{number}")
        ledger = spark.createDataFrame([], SPLIT_LEDGER)
        for turn, page in enumerate([*order, rng.choice(pages), rng.choice(pages)]):
            landing.page(f"{turn}.json", *page)
            path = f"{landing.root}/{turn}.json"
            events = split_events(read_split_pages(spark, path), at(turn))
            ledger = merge_events(ledger, events, landed_files(spark, path), at(turn))
            ledger = ledger.withColumn("as_of_date", F.lit(at(turn)))
        rows = active_splits(ledger).collect()
        found.add(tuple(sorted(map(tuple, rows))))
    assert len(found) == 1 and len(found.pop()) == 4


def test_the_inverse_brings_history_back(spark, make_splits):
    before = make_splits(("A", "2000-01-03", 1, 10), ("A", "2000-01-03", 2, 3), ("B", "2000-01-03", 1, 2))
    after = make_splits(("A", "2000-01-03", 1, 10), ("C", "2000-01-04", 3, 1))
    there = {tuple(r) for r in changed_ratios(before, after).collect()}
    back = {tuple(r) for r in changed_ratios(after, before).collect()}
    assert there == {
        ("2000-01-03", 30.0, 20.0, "A"), ("2000-01-03", 2.0, 1.0, "B"), ("2000-01-04", 3.0, 1.0, "C")
    }
    assert {(d, b / a, t) for d, a, b, t in there} == {(d, a / b, t) for d, a, b, t in back}
    assert changed_ratios(before, before).count() == 0


def test_only_new_files_are_read(spark, feed, monkeypatch):
    landing, load, tables = feed
    from barweave.plans import daily

    read = []
    real = daily.read_split_pages
    monkeypatch.setattr(
        daily, "read_split_pages", lambda s, names, m: (read.append(len(names)), real(s, names, m))[1]
    )
    for offset in range(1, 6):
        for part in range(2):
            landing.page(f"{offset}-{part}.json", result(f"T{offset}{part}", at(offset), 1, 2))
        assert len(load(offset)) == 2
    assert read == [2] * 5  # as many on the last day as on the first
    assert load(6) == [] and read == [2] * 5
    assert read_newest_partition(spark, tables.split_files, FEED_FILES).count() == 10
    # A day without new pages has no partition of its own.
    assert partition_dates(spark, tables.split_ledger) == [at(offset) for offset in range(6)]


def test_old_splits_leave_the_ledger(spark, feed, tmp_path):
    landing, load, tables = feed
    old, kept = at(1) - timedelta(days=366), at(1) - timedelta(days=365)
    landing.page("1.json", result("A", old, 1, 2), result("A", kept, 1, 3))
    assert load(1) == [("A", str(kept), 1.0, 3.0)]
    landing.page("2.json")
    assert load(2) == []
    assert read_partition(spark, tables.split_ledger, SPLIT_LEDGER, at(2)).count() == 0


@pytest.mark.parametrize("own_url", [True, False])
@pytest.mark.parametrize("lost", [None, 0, 1, 2])
def test_a_chain_must_be_whole(feed, own_url, lost):
    landing, load, tables = feed
    for number in range(3):
        envelope = {"count": 1}
        if own_url:
            envelope["url"] = f"feed?page={number}"
        if number < 2:
            envelope["next_url"] = f"feed?page={number + 1}"
        if number != lost:
            landing.page(f"poll_{number}.json", result(f"T{number}", at(1), 1, 2), **envelope)
    if lost in (1, 2):
        for _ in range(2):
            with pytest.raises(DataQualityError, match="page_chains_are_whole_check"):
                load(1)
        # The lost page lands: the day goes on from where it was.
        more = {"url": f"feed?page={lost}"} if own_url else {}
        if lost == 1:
            more["next_url"] = "feed?page=2"
        landing.page(f"poll_{lost}.json", result(f"T{lost}", at(1), 1, 2), **more)
    assert len(load(1)) == (2 if lost == 0 else 3)


def test_a_single_page_of_a_known_chain_lands_again(feed):
    landing, load, _ = feed
    landing.page("a_0.json", result("A", EVE, 1, 2), url="p0", next_url="p1")
    landing.page("a_1.json", result("B", EVE, 1, 2), url="p1")
    assert len(load(1)) == 2
    landing.page("again.json", result("A", EVE, 1, 2), url="p0", next_url="p1")
    assert load(2) == []


@pytest.mark.parametrize(
    "text",
    [
        "",
        " \n",
        '{"status": "ERROR", "error": "limit"}',
        '{"status": "ERROR", "results": []}',
        '{"status": "OK"}',
        '{"status": "OK", "count": 2, "results": []}',
        '{"status": "OK", "results": [',
    ],
)
def test_pages_without_their_results_stop_the_day(spark, feed, text):
    landing, load, tables = feed
    landing.page("good.json", result("A", at(1), 1, 2))
    landing.text("bad.json", text)
    with pytest.raises(Exception, match="(?i)page|malformed"):
        load(1)
    assert read_partition(spark, tables.split_ledger, SPLIT_LEDGER, at(1)).count() == 0
    with pytest.raises(Exception, match="(?i)page|malformed"):
        read_splits(spark, str(landing.root), EVE, at(1)).collect()
    landing.text("bad.json", '{"status": "OK", "results": []}')
    assert len(load(1)) == 1


@pytest.mark.parametrize("on", ["2000-13-45", None])
def test_a_split_without_a_readable_date_stops_the_day(feed, on):
    landing, load, _ = feed
    landing.page("1.json", {"ticker": "A", "execution_date": on, "split_from": 1, "split_to": 2})
    with pytest.raises(DataQualityError, match="execution_date_is_not_null_check"):
        load(1)


def test_quote_pages_without_bars_raise(spark, tmp_path):
    (tmp_path / "q.json").write_text('{"status": "limit", "message": "too many requests"}')
    for lines in (True, False):
        with pytest.raises(Exception, match="a page without bars, status limit"):
            read_quotes(spark, str(tmp_path), multi_line=not lines).collect()


NAMES = ["a} {b", 'q"} {"', "back\\", 'b\\"} { "x', "z\n}\n{", "é } {", "\\u007d {", "},{"]


@pytest.mark.parametrize("between", ["", " ", "\n"])
def test_strings_are_read_as_written(spark, tmp_path, between):
    documents = [
        {"status": "OK", "results": [result(name, EVE, 1, 2) for name in NAMES[:4]]},
        {"status": "OK", "results": [result(name, EVE, 1, 2) for name in NAMES[4:]]},
    ]
    for ascii_only in (True, False):
        text = between.join(json.dumps(d, indent=1, ensure_ascii=ascii_only) for d in documents)
        (tmp_path / "pages.json").write_text(text)
        rows = read_splits(spark, str(tmp_path), EVE, EVE).collect()
        assert [r["ticker"] for r in rows] == NAMES


def test_files_are_new_until_recorded(spark, tmp_path):
    landing = Landing(tmp_path / "x y")
    landing.page("a b.json")
    landing.page("c.json")
    landed = landed_files(spark, str(landing.root))
    record = landed.filter("path LIKE '%c.json'").drop("name")
    (fresh,) = new_files(landed, record).collect()
    assert fresh["name"].endswith("x y/a b.json")
    assert read_split_pages(spark, [fresh["name"]]).count() == 1
    shutil.copy(landing.root / "c.json", landing.root / "d.json")
    landing.page("c.json", result("A", EVE, 1, 2))
    assert new_files(landed_files(spark, str(landing.root)), record).count() == 3
