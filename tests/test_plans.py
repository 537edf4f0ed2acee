"""The physical plans that make the work scale."""

from datetime import date

import pytest
from conftest import day
from pyspark.sql import functions as F

from barweave.operators.leaderboard import leaderboard
from barweave.operators.quotes import latest_quote
from barweave.operators.splits import adjust_bars
from barweave.plans.history import backfill_cumulative, daily_step, unsplit_tickers
from barweave.plans.reference_prices import dim_prices
from barweave.schemas import BARS, CUMULATIVE
from barweave.sinks.tables import publish_partition, replace_table
from barweave.sources.tables import read_bucketed_partition, read_partition, reference_columns


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Tables beyond the broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def bucketed(spark, tmp_path, make_arrays):
    rows = make_arrays(*[(f"T{i}", "2000-01-03", [("2000-01-03", 1.0 + i)]) for i in range(20)])
    publish_partition(
        rows.repartition(4, "ticker"), str(tmp_path / "c"), CUMULATIVE, day("2000-01-03"), buckets=4
    )
    return read_bucketed_partition(spark, str(tmp_path / "c"), CUMULATIVE, day("2000-01-03"), 4)


def test_step_over_a_bucketed_table_never_shuffles_the_arrays(
    spark, no_broadcast, bucketed, make_bars, make_splits
):
    step = daily_step(
        bucketed, make_bars(("T1", "2000-01-04", 2.0)), make_splits(("T2", "2000-01-04", 1, 2)),
        day("2000-01-04"),
    )
    text = plan(step)
    assert "FullOuter" in text and "Bucketed: true" in text
    assert "Generate" not in text and "BroadcastNestedLoop" not in text

    def below_exchange(node, under=False):
        """Names of the columns that pass through any exchange."""
        under = under or node.nodeName() == "Exchange"
        names = []
        if node.nodeName() == "Exchange":
            names = [node.output().apply(i).name() for i in range(node.output().size())]
        children = node.children()
        return names + [
            name for i in range(children.size()) for name in below_exchange(children.apply(i), under)
        ]

    step.collect()
    adaptive = step._jdf.queryExecution().executedPlan()
    shuffled = below_exchange(adaptive.initialPlan())
    assert shuffled and not {"price_array", "older"} & set(shuffled)


def test_bucketed_and_plain_steps_agree(spark, bucketed, make_bars, make_splits, make_arrays):
    plain = make_arrays(*[(f"T{i}", "2000-01-03", [("2000-01-03", 1.0 + i)]) for i in range(20)])
    inputs = (
        make_bars(("T1", "2000-01-04", 2.0), ("N", "2000-01-04", 2.0)),
        make_splits(("T2", "2000-01-04", 1, 2)),
        day("2000-01-04"),
    )
    a = sorted(daily_step(bucketed, *inputs).collect(), key=str)
    assert a == sorted(daily_step(plain, *inputs).collect(), key=str)


def test_unsplit_tickers_is_an_anti_join(spark, make_arrays, make_splits):
    arrays = make_arrays(("A", "2000-01-03", []))
    assert "LeftAnti" in plan(unsplit_tickers(arrays, make_splits(), day("2000-01-04")))


def test_backfill_combines_before_the_shuffle_and_joins_per_ticker(
    spark, no_broadcast, make_bars, make_splits
):
    bars = make_bars(("A", "2000-01-03", 1.0))
    text = plan(backfill_cumulative(bars, make_splits(), as_of=date(2000, 1, 3)))
    assert "partial_max(struct(volume" in text
    assert "Window" not in text and "NestedLoop" not in text
    # The bar side: one shuffle to combine bars per day, one to collect arrays, none to join.
    bar_side = [line for line in text.splitlines() if line.lstrip().startswith(":")]
    assert sum("Exchange hashpartitioning" in line for line in bar_side) == 2


@pytest.fixture
def tiny_partitions(spark, no_broadcast):
    """Skew limits small enough for test data."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def test_a_ticker_with_a_third_of_the_bars_is_split_up(
    spark, tiny_partitions, tmp_path, make_bars, make_splits
):
    """Beyond the broadcast limit, the hot ticker's bars are joined by several tasks."""
    number = F.col("id")
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(number % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), number)).alias("ticker"),
        F.xxhash64("id").alias("volume"),
        *[(number * 4.0).alias(name) for name in ("open", "close", "high", "low")],
        F.xxhash64("id").alias("window_start"),
        number.alias("transactions"),
        F.date_add(F.lit("1990-01-01"), (number / 10).cast("int")).alias("snapshot_date"),
    )
    path = str(tmp_path / "bars")
    rows.write.parquet(path)
    splits = make_splits(("HOT", "1993-01-01", 1, 2), ("HOT", "1997-01-01", 1, 2))
    adjusted = adjust_bars(spark.read.schema(BARS).parquet(path), splits)
    found = adjusted.collect()
    assert "skew=true" in plan(adjusted)
    assert len(found) == 30_000
    for row in found:
        year, share = row["snapshot_date"].year, 4.0
        if row["ticker"] == "HOT":
            share = 1.0 if year < 1993 else 2.0 if year < 1997 else 4.0
        assert row["close"] == row["transactions"] * share


def test_dimension_reads_two_of_seven_fields_and_does_not_shuffle(spark, tmp_path, make_arrays):
    path = str(tmp_path / "c")
    publish_partition(make_arrays(("A", "2000-01-03", [])), path, CUMULATIVE, day("2000-01-03"))
    arrays = read_partition(spark, path, CUMULATIVE, day("2000-01-03"))
    text = plan(dim_prices(arrays, day("2000-01-03")))
    assert "Exchange" not in text
    assert "price_array:array<struct<close:double,snapshot_date:date>>" in text


def test_board_is_a_top_k_without_a_global_sort(spark, tmp_path, make_bars):
    bars = make_bars(("A", "2000-01-03", 1.0)).withColumnRenamed("close", "m")
    text = plan(leaderboard(bars, "m", False))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_projection_scan_reads_four_columns(spark, tmp_path):
    from barweave.schemas import CURRENT_DAY

    path = str(tmp_path / "t")
    replace_table(spark.createDataFrame([], CURRENT_DAY), path, CURRENT_DAY)
    text = plan(reference_columns(spark.read.schema(CURRENT_DAY).parquet(path)))
    schema = text[text.index("ReadSchema") :]
    assert "close_price_last_day" in schema and "current_price" not in schema


def test_latest_quote_combines_before_the_shuffle(spark):
    updates = spark.createDataFrame(
        [], "ticker string, current_price double, last_updated_datetime timestamp"
    )
    text = plan(latest_quote(updates))
    assert "partial_max" in text and text.count("Exchange") == 1


def test_bars_filter_reaches_the_partitions(spark, tmp_path, make_bars, make_arrays, make_splits):
    path = str(tmp_path / "bars")
    replace_table(
        make_bars(("A", "2000-01-03", 1.0), ("A", "2000-01-04", 1.0)), path, BARS, ["snapshot_date"]
    )
    bars = spark.read.schema(BARS).parquet(path)
    step = daily_step(make_arrays(), bars, make_splits(), day("2000-01-04"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan(step)
