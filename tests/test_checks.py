import pytest
from conftest import day
from pyspark.sql import functions as F

from barweave.operators import checks
from barweave.operators.checks import DataQualityError, run_checks


def result(frame):
    return frame.first().asDict()


@pytest.mark.parametrize("column", checks.BAR_COLUMNS)
def test_a_null_fails_the_check_of_its_column_only(spark, make_bars, column):
    bars = make_bars(("A", "2000-01-03", 1.0), ("B", "2000-01-03", 1.0))
    nulled = F.when(F.col("ticker") != "A", F.col(column))
    found = result(checks.check_bars(bars.withColumn(column, nulled)))
    assert [name for name, passed in found.items() if not passed] == [
        f"{column}_is_not_null_check"
    ]


def test_empty_input_passes(spark, make_bars, make_splits):
    run_checks(checks.check_bars(make_bars()), checks.check_splits(make_splits()))


@pytest.mark.parametrize("bad", [0, -1])
def test_split_ratios_must_be_positive(spark, make_splits, bad):
    found = result(checks.check_splits(make_splits(("A", "2000-01-01", bad, 1))))
    assert found["split_from_is_positive_check"] is False
    assert found["split_to_is_positive_check"] is True


@pytest.mark.parametrize(
    "staged, previous, passes",
    [(100, 100, True), (101, 100, False), (1009, 1000, True), (1010, 1000, False),
     (1, 1000, True), (0, 0, False), (1, 0, False)],
)
def test_growth_is_strictly_below_one_percent(spark, staged, previous, passes):
    check = checks.check_growth(spark.range(staged), spark.range(previous))
    assert result(check) == {"new_rows_under_threshold_check": passes}


def test_bars_of_another_day_and_duplicates_are_found(spark, make_bars):
    bars = make_bars(("A", "2000-01-03", 1.0), ("A", "2000-01-03", 2.0))
    run_checks(checks.check_day(bars, day("2000-01-03")))
    with pytest.raises(DataQualityError, match="snapshot_date_is_day_check"):
        run_checks(checks.check_day(bars, day("2000-01-04")))
    with pytest.raises(DataQualityError, match="bars_are_unique_check"):
        run_checks(checks.check_unique(bars))


def test_runner_names_every_failure_and_counts_null_as_one(spark):
    first = spark.sql("SELECT true AS a, false AS b, 7 AS n")
    second = spark.sql("SELECT CAST(NULL AS BOOLEAN) AS c")
    with pytest.raises(DataQualityError, match="^b, c$"):
        run_checks(first, second)


def test_a_check_without_rows_is_an_error(spark):
    passing = spark.sql("SELECT true AS a")
    with pytest.raises(DataQualityError, match="no row"):
        run_checks(passing, passing.filter("NOT a"))
