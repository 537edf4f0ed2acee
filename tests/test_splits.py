import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from barweave.operators.splits import (
    adjust_bars,
    combined_ratio,
    cumulative_factors,
    match_factors,
    rank_splits,
)


def rounded(x: float) -> float:
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def brute_factors(rows):
    """(ticker, date, from, to) rows -> the same with rank and cumulative factors."""
    result, by_ticker = [], {}
    for row in rows:
        by_ticker.setdefault(row[0], []).append(row)
    for ticker, own in by_ticker.items():
        own.sort(key=lambda r: (r[1], r[2], r[3]), reverse=True)
        f = t = None
        for rank, (_, on, split_from, split_to) in enumerate(own, 1):
            f = split_from if f is None else rounded(f * split_from)
            t = split_to if t is None else rounded(t * split_to)
            result.append((ticker, on, f, t, rank))
    return sorted(result)


def random_splits(seed, n=120):
    generator = random.Random(seed)
    start = date(2000, 1, 1)
    return [
        (
            # One ticker holds a third of the rows, with many equal dates.
            "HOT" if i % 3 == 0 else f"T{generator.randint(0, 15)}",
            str(start + timedelta(days=generator.randint(0, 12))),
            generator.choice([1.0, 2.0, 3.0, 1.3333, 0.123456]),
            generator.choice([1.0, 1.5, 10.0, 0.98765432]),
        )
        for i in range(n)
    ]


def test_factors_equal_a_step_by_step_product(spark, make_splits):
    for seed in range(3):
        rows = random_splits(seed)
        found = sorted(
            (r["ticker"], str(r["execution_date"]), r["split_from"], r["split_to"], r["row_number"])
            for r in cumulative_factors(make_splits(*rows)).collect()
        )
        assert found == brute_factors(rows)


def test_ranks_are_newest_first_and_complete(spark, make_splits):
    rows = random_splits(7)
    ranked = rank_splits(make_splits(*rows)).collect()
    expected = sorted((t, on, rank) for t, on, _, _, rank in brute_factors(rows))
    assert sorted((r["ticker"], str(r["execution_date"]), r["row_number"]) for r in ranked) == expected


def test_the_newest_ratio_is_not_rounded(spark, make_splits):
    row = cumulative_factors(make_splits(("A", "2000-01-01", 1, 1.23456789))).first()
    assert row["split_to"] == 1.23456789


def test_as_of_match_equals_a_range_join(spark, make_bars, make_splits):
    rows = random_splits(11)
    bars = [
        (ticker, str(date(1999, 12, 28) + timedelta(days=i)), 100.0 + i)
        for ticker in ("HOT", "T1", "T2", "NONE")
        for i in range(20)
    ]
    factors = brute_factors(rows)
    expected = {}
    for ticker, on, _ in bars:
        later = [f for f in factors if f[0] == ticker and f[1] > on]
        best = max(later, key=lambda f: f[4], default=None)
        expected[ticker, on] = best and (best[2], best[3])
    found = {
        (r["ticker"], str(r["snapshot_date"])): r["split_from"] and (r["split_from"], r["split_to"])
        for r in match_factors(make_bars(*bars), make_splits(*rows)).collect()
    }
    assert found == expected


def test_a_split_does_not_change_bars_of_its_own_day(spark, make_bars, make_splits):
    bars = make_bars(("A", "2024-06-07", 1200.0), ("A", "2024-06-10", 121.0))
    adjusted = adjust_bars(bars, make_splits(("A", "2024-06-10", 1, 10)))
    found = {str(r["snapshot_date"]): (r["close"], r["volume"]) for r in adjusted.collect()}
    assert found == {"2024-06-07": (120.0, 1000.0), "2024-06-10": (121.0, 100.0)}


def test_same_day_splits_multiply(spark, make_splits):
    splits = make_splits(("A", "2000-01-01", 1, 2), ("A", "2000-01-01", 3, 1))
    row = combined_ratio(splits).first()
    assert (row["split_from"], row["split_to"]) == (3.0, 2.0)


def test_bars_never_multiply(spark, make_bars, make_splits):
    bars = make_bars(("A", "1999-01-01", 1.0))
    splits = make_splits(*[("A", f"2000-01-{d:02d}", 1, 2) for d in range(1, 29)])
    assert match_factors(bars, splits).count() == 1


def test_identical_split_rows_each_count(spark, make_bars, make_splits):
    splits = make_splits(*[("A", "2000-01-01", 1, 2)] * 3)
    adjusted = adjust_bars(make_bars(("A", "1999-01-01", 80.0)), splits)
    assert adjusted.first()["close"] == 10.0
    ranks = [r["row_number"] for r in rank_splits(splits).orderBy("row_number").collect()]
    assert ranks == [1, 2, 3]


def test_execution_dates_are_text(spark, make_splits):
    splits = make_splits(("A", "2000-01-01", 1, 2))
    assert dict(splits.dtypes)["execution_date"] == "string"
    assert dict(cumulative_factors(splits).dtypes)["execution_date"] == "date"
    assert splits.filter(F.col("as_of_date").isNull()).count() == 0
