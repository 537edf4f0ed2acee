import random
from datetime import date, timedelta

import pytest
from conftest import closes, day

from barweave.operators.bars import one_bar_per_day, positioned_prices, unnest_prices
from barweave.plans.history import (
    apply_late_splits,
    backfill_cumulative,
    daily_step,
    late_splits,
    split_tickers,
    unsplit_tickers,
)
from barweave.plans.reference_prices import dim_prices, init_current_day
from pyspark.sql import functions as F


def test_backfill_keeps_365_days_and_every_ticker(spark, make_bars, make_splits):
    newest = date(2000, 12, 31)
    inside, outside = newest - timedelta(days=364), newest - timedelta(days=365)
    bars = make_bars(
        ("A", str(newest), 1.0), ("A", str(inside), 2.0), ("A", str(outside), 3.0),
        ("OLD", str(outside), 4.0),
    )
    result = closes(backfill_cumulative(bars, make_splits()))
    assert result == {"A": [(str(newest), 1.0), (str(inside), 2.0)], "OLD": None}


def test_backfill_keeps_invalid_bars_unless_told_otherwise(spark, make_bars, make_splits):
    bars = make_bars(("A", "2000-01-01", 1.0), volume=0)
    assert closes(backfill_cumulative(bars, make_splits())) == {"A": [("2000-01-01", 1.0)]}
    assert closes(backfill_cumulative(bars, make_splits(), valid_only=True)) == {}


def test_duplicate_bars_leave_one_whole_bar(spark, make_bars, make_splits):
    bars = make_bars(*[("A", "2000-01-01", float(c)) for c in range(1, 30)])
    bars = bars.withColumn("open", F.col("close") * 7)
    kept = one_bar_per_day(bars, F.col("snapshot_date")).collect()
    assert len(kept) == 1 and kept[0]["open"] == kept[0]["close"] * 7
    again = one_bar_per_day(bars.repartition(7), F.col("snapshot_date")).collect()
    assert again == kept
    assert len(closes(backfill_cumulative(bars, make_splits()))["A"]) == 1


def test_a_ticker_with_most_rows_equals_brute_force(spark, make_bars, make_splits):
    """Many duplicates of one ticker, and few bars of the others."""
    generator = random.Random(5)
    start = date(2000, 1, 1)
    rows = [
        ("HOT" if i % 3 == 0 else f"T{i % 40}", str(start + timedelta(days=generator.randint(0, 30))),
         float(generator.randint(1, 9) * 4))
        for i in range(900)
    ]
    splits = [("HOT", "2000-01-10", 1, 2), ("HOT", "2000-01-20", 1, 2), ("T1", "2000-01-15", 2, 1)]
    expected = {}
    for ticker, on, close in rows:
        days = expected.setdefault(ticker, {})
        days[on] = max(close, days.get(on, 0.0))
    for ticker, days in expected.items():
        for on in days:
            for name, executed, split_from, split_to in splits:
                if name == ticker and on < executed:
                    days[on] *= split_from / split_to
    found = closes(backfill_cumulative(make_bars(*rows), make_splits(*splits)))
    assert found == {t: sorted(days.items(), reverse=True) for t, days in expected.items()}


def test_step_covers_old_new_and_both(spark, make_bars, make_arrays, make_splits):
    before = make_arrays(
        ("BOTH", "2000-01-03", [("2000-01-03", 1.0)]), ("GONE", "2000-01-03", [("2000-01-03", 2.0)])
    )
    today = make_bars(("BOTH", "2000-01-04", 3.0), ("NEW", "2000-01-04", 4.0))
    result = closes(daily_step(before, today, make_splits(), day("2000-01-04")))
    assert result == {
        "BOTH": [("2000-01-04", 3.0), ("2000-01-03", 1.0)],
        "GONE": [("2000-01-03", 2.0)],
        "NEW": [("2000-01-04", 4.0)],
    }


@pytest.mark.parametrize("field", ["volume", "open", "close", "high", "low", "transactions"])
def test_step_drops_bars_with_a_non_positive_field(
    spark, make_bars, make_arrays, make_splits, field
):
    zero = 0 if field in ("volume", "transactions") else 0.0
    today = make_bars(("A", "2000-01-04", 3.0), **{field: zero})
    before = make_arrays(("B", "2000-01-03", [("2000-01-03", 1.0)]))
    assert set(closes(daily_step(before, today, make_splits(), day("2000-01-04")))) == {"B"}


def test_step_ignores_other_days(spark, make_bars, make_arrays, make_splits):
    """Bars, splits and partitions of other days must not leak in."""
    before = make_arrays(
        ("A", "2000-01-03", [("2000-01-03", 8.0)]), ("A", "2000-01-02", [("2000-01-02", 9.0)])
    )
    bars = make_bars(("A", "2000-01-05", 1.0))
    splits = make_splits(("A", "2000-01-03", 1, 2))
    result = daily_step(before, bars, splits, day("2000-01-04"))
    assert closes(result) == {"A": [("2000-01-03", 8.0)]}
    assert result.count() == 1


def test_two_splits_on_one_day_do_not_duplicate_bars(spark, make_bars, make_arrays, make_splits):
    before = make_arrays(("A", "2000-01-03", [("2000-01-03", 60.0)]))
    splits = make_splits(("A", "2000-01-04", 1, 2), ("A", "2000-01-04", 1, 3))
    result = closes(daily_step(before, make_bars(), splits, day("2000-01-04")))
    assert result == {"A": [("2000-01-03", 10.0)]}


def test_split_ticker_with_an_empty_array_stays(spark, make_bars, make_arrays, make_splits):
    before = make_arrays(("A", "2000-01-03", [("1998-01-01", 1.0)]), ("B", "2000-01-03", []))
    splits = make_splits(("A", "2000-01-04", 1, 2), ("B", "2000-01-04", 1, 2))
    result = daily_step(before, make_bars(), splits, day("2000-01-04"))
    assert closes(result) == {"A": [], "B": []}
    assert unnest_prices(result).count() == 0
    assert positioned_prices(result).count() == 2


def test_split_and_unsplit_tickers_partition_the_table(spark, make_arrays, make_splits):
    before = make_arrays(
        ("A", "2000-01-03", [("2000-01-03", 10.0)]), ("B", "2000-01-03", [("2000-01-03", 20.0)])
    )
    splits = make_splits(("A", "2000-01-04", 1, 2), ("C", "2000-01-04", 1, 2))
    assert closes(split_tickers(before, splits, day("2000-01-04"))) == {"A": [("2000-01-03", 5.0)]}
    assert closes(unsplit_tickers(before, splits, day("2000-01-04"))) == {
        "B": [("2000-01-03", 20.0)]
    }


def test_forward_split_leaves_a_steady_value_near_zero_change(
    spark, make_bars, make_arrays, make_splits
):
    before = make_arrays(("NV", "2024-06-09", [("2024-06-07", 1208.0), ("2024-06-06", 1209.0)]))
    today = make_bars(("NV", "2024-06-10", 121.0))
    split = make_splits(("NV", "2024-06-10", 1, 10))
    arrays = daily_step(before, today, split, day("2024-06-10"))
    prices = dim_prices(arrays, day("2024-06-10")).first()
    change = 100 * (121.0 - prices["close_price_avg_last_90_days"]) / 121.0
    assert abs(change) < 1


def test_late_split_is_applied_exactly_once(spark, make_arrays, make_splits):
    stored = make_arrays(
        ("ST", "2024-06-27", [("2024-06-27", 3.0), ("2024-06-26", 3.2), ("2024-06-25", 0.016)]),
        ("XX", "2024-06-27", [("2024-06-25", 5.0)]),
    )
    feed = make_splits(("ST", "2024-06-26", 200, 1), ("XX", "2024-06-01", 1, 2))
    applied = make_splits(("XX", "2024-06-01", 1, 2))
    fixed = apply_late_splits(stored, feed, applied)
    assert closes(fixed) == {
        "ST": [("2024-06-27", 3.0), ("2024-06-26", 3.2), ("2024-06-25", 3.2)],
        "XX": [("2024-06-25", 5.0)],
    }
    applied = applied.unionByName(late_splits(feed, applied))
    assert closes(apply_late_splits(fixed, feed, applied)) == closes(fixed)


def test_duplicate_bars_of_the_day_leave_one(spark, make_arrays, make_bars, make_splits):
    before = make_arrays(("A", "2000-01-03", [("2000-01-03", 5.0)]))
    today = make_bars(*[("A", "2000-01-04", float(c)) for c in range(1, 30)])
    result = closes(daily_step(before, today, make_splits(), day("2000-01-04")))
    assert result == {"A": [("2000-01-04", 29.0), ("2000-01-03", 5.0)]}


def test_a_corrected_ratio_is_applied_once(spark, make_arrays, make_splits):
    stored = make_arrays(("A", "2024-06-27", [("2024-06-27", 3.0), ("2024-06-25", 6.0)]))
    applied = make_splits(("A", "2024-06-26", 1, 2))
    feed = make_splits(("A", "2024-06-26", 1, 3))
    fixed = apply_late_splits(stored, feed, applied)
    assert closes(fixed) == {"A": [("2024-06-27", 3.0), ("2024-06-25", 4.0)]}
    applied = applied.unionByName(late_splits(feed, applied))
    assert late_splits(feed, applied).isEmpty()


def test_a_late_split_without_a_ratio_reaches_the_checks(spark, make_splits):
    feed = make_splits(("A", "2024-06-26", 1, 2)).withColumn("split_to", F.lit(None).cast("double"))
    assert late_splits(feed, make_splits()).count() == 1


def test_a_second_split_of_a_day_is_not_ignored(spark, make_arrays, make_splits):
    stored = make_arrays(("A", "2024-06-27", [("2024-06-25", 6.0)]))
    applied = make_splits(("A", "2024-06-26", 1, 2))
    feed = make_splits(("A", "2024-06-26", 1, 2), ("A", "2024-06-26", 1, 3))
    assert closes(apply_late_splits(stored, feed, applied)) == {"A": [("2024-06-25", 2.0)]}


def test_last_close_on_a_holiday(spark, make_arrays):
    arrays = make_arrays(("A", "2000-07-04", [("2000-07-03", 7.0), ("2000-06-30", 5.0)]))
    holiday = day("2000-07-04")  # a Tuesday without bars
    assert dim_prices(arrays, holiday).first()["close_price_last_day"] is None
    assert dim_prices(arrays, holiday, "latest").first()["close_price_last_day"] == 7.0


def test_averages_of_empty_and_missing_arrays_are_null(spark, make_arrays):
    arrays = make_arrays(("E", "2000-01-04", []), ("N", "2000-01-04", None))
    for mode in ("weekday", "latest"):
        for row in dim_prices(arrays, day("2000-01-04"), mode).collect():
            assert row[1:4] == (None, None, None)


def test_the_quarter_is_ninety_days(spark, make_arrays):
    as_of = day("2000-06-30")
    inside, outside = as_of - timedelta(days=89), as_of - timedelta(days=90)
    arrays = make_arrays(("A", "2000-06-30", [(str(inside), 2.0), (str(outside), 4.0)]))
    row = dim_prices(arrays, as_of).first()
    assert row["close_price_avg_last_90_days"] == 2.0
    assert row["close_price_avg_last_365_days"] == 3.0


def test_current_day_uses_the_newest_details(spark, make_arrays):
    arrays = make_arrays(("A", "2000-01-04", [("2000-01-04", 1.0)]), ("B", "2000-01-04", []))
    details = spark.createDataFrame(
        [("A", "Mid Cap", day("2000-01-01")), ("A", "Large Cap", day("2000-01-02")),
         ("B", "Mega Cap", day("2000-01-01"))],
        "ticker string, market_cap_description string, as_of_date date",
    )
    current = init_current_day(dim_prices(arrays, day("2000-01-04")), details, day("2000-01-04"))
    found = {row["ticker"]: row for row in current.collect()}
    assert found["A"]["market_cap_description"] == "Large Cap"
    assert found["B"]["market_cap_description"] == "Not Provided"
    assert found["A"]["current_price"] is None and found["A"]["last_updated_datetime"] is None
    assert len(current.columns) == 13


@pytest.mark.parametrize("seed", [1, 2])
def test_stepping_equals_backfilling(spark, make_bars, make_splits, seed):
    """Backfill to N0, then step day by day to N1 = backfill at N1, up to rounding."""
    generator = random.Random(seed)
    start, steps = date(2000, 1, 1), 4
    first = start + timedelta(days=400)
    tickers = [f"T{i}" for i in range(6)]
    bars = make_bars(
        *[
            (ticker, str(start + timedelta(days=offset)), round(generator.uniform(5, 500), 2))
            for ticker in tickers
            for offset in range(400 + steps + 1)
            if generator.random() < 0.6
        ]
    ).cache()
    last = first + timedelta(days=steps)
    splits = make_splits(
        *[
            (ticker, str(start + timedelta(days=generator.randint(300, 400 + steps))),
             generator.choice([1, 2, 5]), generator.choice([1, 3, 10]))
            for ticker in tickers
        ],
        (tickers[0], str(first + timedelta(days=2)), 1, 4),
    )

    def known(until):
        return splits.filter(F.col("execution_date") <= str(until))

    arrays = backfill_cumulative(bars, known(first), as_of=first)
    for offset in range(1, steps + 1):
        today = first + timedelta(days=offset)
        rows = daily_step(arrays, bars, splits, today).collect()
        arrays = spark.createDataFrame(rows, arrays.schema)
    stepped, built = closes(arrays), closes(backfill_cumulative(bars, known(last), as_of=last))
    assert stepped.keys() == built.keys()
    for ticker, array in built.items():
        dates = [on for on, _ in stepped[ticker]]
        assert dates == [on for on, _ in array]
        assert dates == sorted(set(dates), reverse=True)
        assert min(dates) > str(last - timedelta(days=365))
        for (_, a), (_, b) in zip(stepped[ticker], array):
            assert a == pytest.approx(b, rel=1e-3)


def test_a_backfill_leaves_later_splits_to_their_day(spark, make_bars, make_splits):
    bars = make_bars(("A", "2000-01-03", 100.0))
    splits = make_splits(("A", "2000-01-05", 1, 10))
    arrays = backfill_cumulative(bars, splits, as_of=day("2000-01-04"))
    assert closes(arrays) == {"A": [("2000-01-03", 100.0)]}
