from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from barweave.operators.leaderboard import change_by_cap, leaderboard
from barweave.operators.merge import merge_matched
from barweave.operators.quotes import latest_quote, price_updates, quote_metrics, tradable_symbols
from barweave.plans.intraday import apply_quotes
from barweave.schemas import CURRENT_DAY, METRICS, UPDATED_COLUMNS


@pytest.fixture
def make_current(spark):
    """Rows of (ticker, reference price for all three bases, category)."""

    def make(*rows, **values):
        data = []
        for ticker, base, cap in rows:
            row = dict.fromkeys(CURRENT_DAY.fieldNames())
            row.update({name: base for name in METRICS})
            row.update(ticker=ticker, market_cap_description=cap, **values)
            data.append(tuple(row[name] for name in CURRENT_DAY.fieldNames()))
        return spark.createDataFrame(data, CURRENT_DAY)

    return make


def quotes(spark, *rows):
    return spark.createDataFrame(rows, "ticker string, c double, t string")


def by_ticker(frame):
    return {row["ticker"]: row for row in frame.collect()}


T1, T2 = "2024-06-26T15:00:00Z", "2024-06-26T15:04:00Z"


def test_update_sets_price_time_and_metrics(spark, make_current):
    current = make_current(("A", 100.0, "Mid Cap"), ("B", 50.0, "Mid Cap"))
    result = by_ticker(apply_quotes(current, quotes(spark, ("A", 110.0, T1), ("Z", 1.0, T1))))
    assert set(result) == {"A", "B"}
    a = result["A"]
    assert a["current_price"] == 110.0
    assert a["m_price_change_last_day"] == 10.0
    assert a["m_price_change_last_365_days_pct"] == 10.0
    assert result["B"]["current_price"] is None


def test_a_real_jump_is_kept(spark, make_current):
    row = apply_quotes(make_current(("ML", 1.0, "Micro Cap")), quotes(spark, ("ML", 4.0, T1)))
    assert row.first()["m_price_change_last_day_pct"] == 300.0


def test_invalid_quotes_change_nothing(spark, make_current):
    current = make_current(("A", 100.0, "Mid Cap"))
    bad = quotes(spark, ("A", 0.0, T2), ("A", -1.0, T2), ("A", None, T2))
    assert apply_quotes(current, bad).collect() == current.collect()


def test_zero_or_missing_base(spark, make_current):
    current = make_current(("Z", 0.0, "x"), ("N", None, "x"))
    result = by_ticker(apply_quotes(current, quotes(spark, ("Z", 5.0, T1), ("N", 5.0, T1))))
    assert result["Z"]["m_price_change_last_day"] == 5.0
    assert result["Z"]["m_price_change_last_day_pct"] is None
    assert result["N"]["m_price_change_last_day"] is None


def test_the_newest_quote_of_a_batch_wins(spark, make_current):
    rows = [("A", 1.0, T1), ("A", 2.0, T2), ("A", 3.0, T1)]
    result = apply_quotes(make_current(("A", 1.0, "x")), quotes(spark, *rows))
    assert result.first()["current_price"] == 2.0


def test_an_older_quote_is_ignored_unless_the_last_write_wins(spark, make_current):
    current = apply_quotes(make_current(("A", 1.0, "x")), quotes(spark, ("A", 2.0, T2)))
    late = quotes(spark, ("A", 9.0, T1))
    assert apply_quotes(current, late).first()["current_price"] == 2.0
    with pytest.raises(ValueError, match="arrival"):
        apply_quotes(current, late, last_write_wins=True)


def arrived(spark, *rows):
    """Rows of (ticker, c, t, second of arrival, file, place)."""
    schema = "ticker string, c double, t string, arrival struct<modified:timestamp,path:string,place:bigint>"
    data = [(a, c, t, (datetime.fromtimestamp(s), path, place)) for a, c, t, s, path, place in rows]
    return spark.createDataFrame(data, schema)


def test_the_last_to_arrive_wins_however_batches_are_cut(spark, make_current):
    rows = [
        ("A", 9.0, T1, 5, "f2", 0), ("A", 8.0, T2, 5, "f1", 9), ("A", 7.0, T2, 4, "f9", 0),
        ("B", 1.0, T2, 1, "f1", 1), ("B", 2.0, T1, 1, "f1", 2), ("B", 0.0, T2, 9, "f3", 0),
        ("C", 3.0, T1, 2, "f1", 0), ("C", 4.0, T1, 2, "f1", 0), ("C", 5.0, None, 2, "f1", 0),
    ]
    start = make_current(*[(name, 1.0, "x") for name in "ABC"])
    for order in (rows, rows[::-1]):
        for size in (1, 3, 7, 9):
            current = start
            for at in range(0, len(order), size):
                current = apply_quotes(current, arrived(spark, *order[at : at + size]), True)
                if size == 1:
                    current = spark.createDataFrame(current.collect(), current.schema)
            found = {row["ticker"]: row["current_price"] for row in current.collect()}
            assert found == {"A": 9.0, "B": 2.0, "C": 4.0}


def test_applying_a_batch_twice_changes_nothing(spark, make_current):
    batch = quotes(spark, ("A", 2.0, T2), ("B", 3.0, T1))
    once = apply_quotes(make_current(("A", 1.0, "x"), ("B", 1.0, "x")), batch)
    assert sorted(apply_quotes(once, batch).collect()) == sorted(once.collect())


def test_merge_equals_the_one_join_form(spark, make_current):
    current = make_current(("A", 3.0, "x"), ("B", 0.0, "x"), ("C", None, "x"))
    batch = quotes(spark, ("A", 2.0, T2), ("A", 1.0, T1), ("B", 5.0, T1), ("Z", 1.0, T1))
    updates = quote_metrics(latest_quote(price_updates(batch)), current)
    merged = merge_matched(current, updates, "ticker", UPDATED_COLUMNS)
    assert sorted(merged.collect(), key=str) == sorted(
        apply_quotes(current, batch).collect(), key=str
    )


def test_merge_overwrites_with_null_and_keeps_the_rest(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, v int, w int")
    source = spark.createDataFrame([("a", None), ("z", 9)], "k string, v int")
    assert sorted(merge_matched(target, source, "k", ["v"]).collect(), key=str) == [
        ("a", None, 10),
        ("b", 2, 20),
    ]


def test_merge_rejects_two_updates_of_one_row(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    source = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    with pytest.raises(PySparkException, match="several updates for a"):
        merge_matched(target, source, "k", ["v"]).collect()


def test_latest_quote_breaks_ties(spark):
    rows = [("A", 5.0, datetime(2024, 1, 1), 1), ("A", 4.0, datetime(2024, 1, 1), 2)]
    updates = spark.createDataFrame(
        rows, "ticker string, current_price double, last_updated_datetime timestamp, id int"
    )
    assert latest_quote(updates, "id").first()["current_price"] == 4.0
    assert latest_quote(updates).first()["current_price"] == 5.0


def test_currency_pairs_are_excluded(spark):
    assets = spark.createDataFrame([("AAPL",), ("BTC/USD",)], "symbol string")
    assert [row["symbol"] for row in tradable_symbols(assets).collect()] == ["AAPL"]


def board_input(spark, make_current, n=60):
    current = make_current(*[(f"T{i:02d}", 100.0, ["Mid Cap", "Mega Cap"][i % 2]) for i in range(n)])
    return apply_quotes(
        current, quotes(spark, *[(f"T{i:02d}", 100.0 + i // 2, T1) for i in range(n - 2)])
    ).cache()


METRIC = "m_price_change_last_day_pct"


def test_boards_are_ordered_limited_and_skip_null(spark, make_current):
    current = board_input(spark, make_current)
    top = [tuple(row) for row in leaderboard(current, METRIC, False).collect()]
    assert len(top) == 50
    assert top[:3] == [("T56", 28.0), ("T57", 28.0), ("T54", 27.0)]
    low = leaderboard(current, METRIC, True).collect()
    assert [row["ticker"] for row in low[:2]] == ["T00", "T01"]


def test_board_filters(spark, make_current):
    current = board_input(spark, make_current)
    assert leaderboard(current, METRIC, False, caps=[]).count() == 50
    assert leaderboard(current, METRIC, False, caps=["Mega Cap"]).count() == 29
    assert leaderboard(current, METRIC, False, caps=["Small Cap"]).count() == 0
    assert leaderboard(current, METRIC, False, tickers=["T01", "T59"]).count() == 1
    selected = leaderboard(current, METRIC, False, n=3)
    assert leaderboard(current, METRIC, True, tickers=selected).count() == 3
    times = (datetime(2024, 6, 27), datetime(2024, 6, 28))
    assert leaderboard(current, METRIC, False, updated=times).count() == 0


def test_change_by_cap(spark, make_current):
    rows = change_by_cap(board_input(spark, make_current), [METRIC])
    by_cap = {row["market_cap_description"]: row for row in rows.collect()}
    mega = by_cap["Mega Cap"]
    assert (mega["tickers"], mega[f"{METRIC}_n"], mega[f"{METRIC}_avg"]) == (30, 29, 14.0)
    assert (mega[f"{METRIC}_min"], mega[f"{METRIC}_max"]) == (0.0, 28.0)


def test_change_by_cap_without_quotes(spark, make_current):
    row = change_by_cap(make_current(("A", 1.0, "x")), [METRIC]).first()
    assert row[f"{METRIC}_n"] == 0 and row[f"{METRIC}_avg"] is None


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_equal_times_do_not_depend_on_batches(spark, make_current, batches):
    feed = [("A", 10.0, T1), ("A", 9.0, T1), ("A", 11.0, T1), ("A", 8.0, T1)]
    current = make_current(("A", 100.0, "Mid Cap"))
    for number in range(batches):
        current = apply_quotes(current, quotes(spark, *feed[number::batches]))
    assert by_ticker(current)["A"]["current_price"] == 11.0
