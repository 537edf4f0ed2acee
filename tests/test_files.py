"""Sources and sinks on real files."""

import gzip
import json
import os
from datetime import date

import pytest
from conftest import closes, day, nanos
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barweave.operators import checks
from barweave.schemas import BAR_CSV, BARS, CUMULATIVE, DIM_PRICES, QUOTE_PAGE, SPLITS
from barweave.sinks import tables
from barweave.sources import json_feeds
from barweave.sources.bars import months_between, read_daily_bars, read_month_bars
from barweave.sources.tables import (
    partition_folder,
    read_bucketed_partition,
    read_partition,
    read_table,
)

HEADER = ",".join(BAR_CSV.fieldNames())


def write_csv(root, on, *rows, header=HEADER):
    folder = root / f"{on:%Y/%m}"
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{on}.csv.gz", "wt") as file:
        file.write("\n".join([header, *rows]) + "\n")


def bar_line(ticker, on, close=1.5):
    return f"{ticker},100,{close},{close},{close},2,{nanos(on)},5"


def write_json(folder, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    for number, document in enumerate(documents):
        (folder / f"page_{number}.json").write_text(json.dumps(document, indent=1))
    return str(folder)


def test_daily_file(spark, tmp_path):
    thursday = day("2000-06-15")
    write_csv(tmp_path, thursday, bar_line("A", thursday), bar_line("B", thursday, 2))
    bars = read_daily_bars(spark, str(tmp_path), thursday)
    assert [(f.name, f.dataType) for f in bars.schema] == [(f.name, f.dataType) for f in BARS]
    assert {(r["ticker"], r["close"], str(r["snapshot_date"])) for r in bars.collect()} == {
        ("A", 1.5, "2000-06-15"),
        ("B", 2.0, "2000-06-15"),
    }


def test_weekend_is_empty_even_when_a_file_exists(spark, tmp_path):
    saturday = day("2000-06-17")
    write_csv(tmp_path, saturday, bar_line("A", saturday))
    bars = read_daily_bars(spark, str(tmp_path), saturday)
    assert bars.schema == BARS and bars.count() == 0


def test_a_missing_weekday_file_is_an_error(spark, tmp_path):
    with pytest.raises(PySparkException):
        read_daily_bars(spark, str(tmp_path), day("2000-06-15")).count()


def test_a_reordered_header_is_an_error(spark, tmp_path):
    thursday = day("2000-06-15")
    swapped = HEADER.replace("open,close", "close,open")
    write_csv(tmp_path, thursday, bar_line("A", thursday), header=swapped)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_daily_bars(spark, str(tmp_path), thursday).collect()


def test_month_folders_are_one_read(spark, tmp_path):
    days = [day(text) for text in ("1999-12-31", "2000-01-03", "2000-01-04", "2000-02-01")]
    for on in days:
        write_csv(tmp_path, on, bar_line("A", on))
    months = months_between(date(1999, 12, 5), date(2000, 1, 20))
    assert months == [date(1999, 12, 1), date(2000, 1, 1)]
    bars = read_month_bars(spark, str(tmp_path), months)
    assert sorted(r["snapshot_date"] for r in bars.collect()) == days[:3]


def test_split_pages(spark, tmp_path):
    def split(ticker, on, a, b):
        return {"ticker": ticker, "execution_date": on, "split_from": a, "split_to": b}

    path = write_json(
        tmp_path / "splits",
        {"status": "OK", "results": [split("A", "2000-01-03", 1, 10), split("B", "2000-01-04", 1, 2)],
         "next_url": "page 2"},
        {"status": "OK", "results": [split("C", "2000-01-04", 3, 1.5)]},
    )
    on = day("2000-01-04")
    one_day = json_feeds.read_splits(spark, path, on, on)
    assert sorted(tuple(r) for r in one_day.collect()) == [
        ("2000-01-04", 1.0, 2.0, "B", on),
        ("2000-01-04", 3.0, 1.5, "C", on),
    ]
    assert json_feeds.read_splits(spark, path, day("2000-01-01"), on).count() == 3
    none = json_feeds.read_splits(spark, path, day("1999-01-01"), day("1999-01-01"))
    assert none.count() == 0 and none.columns == SPLITS.fieldNames()


def test_empty_split_feed(spark, tmp_path):
    path = write_json(tmp_path / "splits", {"status": "OK", "results": []})
    assert json_feeds.read_splits(spark, path, day("2000-01-04"), day("2000-01-04")).count() == 0


def test_failed_lookups_are_skipped(spark, tmp_path):
    path = write_json(
        tmp_path / "details",
        {"results": {"ticker": "A", "name": "Alpha", "market_cap": 5, "active": True}},
        {"status": "NOT_FOUND"},
    )
    rows = json_feeds.read_ticker_documents(spark, path).collect()
    assert [(r["ticker"], r["market_cap"], r["locale"]) for r in rows] == [("A", 5.0, None)]


@pytest.mark.parametrize("pages", [1, 3, 7])
def test_quote_pages(spark, tmp_path, pages):
    bars = {f"T{i}": {"c": i, "t": "2024-06-26T15:00:00Z", "v": 1} for i in range(14)}
    names = sorted(bars)
    parts = [{"bars": {n: bars[n] for n in names[i::pages]}, "next_page_token": str(i)} for i in range(pages)]
    rows = json_feeds.read_quotes(spark, write_json(tmp_path / "q", *parts)).collect()
    assert {r["ticker"]: r["c"] for r in rows} == {f"T{i}": float(i) for i in range(14)}


def test_asset_list_is_a_top_level_array(spark, tmp_path):
    path = write_json(tmp_path / "assets", [{"symbol": "A", "status": "active"}, {"symbol": "B/C"}])
    assert [r["symbol"] for r in json_feeds.read_assets(spark, path).collect()] == ["A", "B/C"]


def test_quote_page_schema_has_no_inference(spark):
    assert QUOTE_PAGE["bars"].dataType.valueType["c"].dataType.typeName() == "double"


def prices(spark, on, *rows):
    data = [(ticker, close, None, None, day(on)) for ticker, close in rows]
    return spark.createDataFrame(data, DIM_PRICES)


def stored(spark, path):
    return sorted((str(r["as_of_date"]), r["ticker"]) for r in read_table(spark, path, DIM_PRICES).collect())


def test_dynamic_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    two = prices(spark, "2000-01-03", ("A", 1.0)).union(prices(spark, "2000-01-04", ("B", 1.0)))
    tables.replace_table(two, path, DIM_PRICES, ["as_of_date"], ["ticker"])
    tables.overwrite_partitions(
        prices(spark, "2000-01-04", ("C", 1.0)), path, DIM_PRICES, ["as_of_date"]
    )
    assert stored(spark, path) == [("2000-01-03", "A"), ("2000-01-04", "C")]
    empty = prices(spark, "2000-01-04")
    tables.overwrite_partitions(empty, path, DIM_PRICES, ["as_of_date"])
    assert len(stored(spark, path)) == 2
    tables.replace_table(empty, path, DIM_PRICES, ["as_of_date"])
    assert stored(spark, path) == []


def test_unpartitioned_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(prices(spark, "2000-01-03", ("A", 1.0), ("B", 1.0)), path, DIM_PRICES)
    tables.replace_table(prices(spark, "2000-01-03", ("C", 1.0)), path, DIM_PRICES)
    assert stored(spark, path) == [("2000-01-03", "C")]


def test_writes_enforce_the_schema(spark, tmp_path):
    wrong = prices(spark, "2000-01-03", ("A", 1.0)).drop("close_price_last_day")
    with pytest.raises(PySparkException):
        tables.replace_table(wrong, str(tmp_path / "t"), DIM_PRICES)


def test_create_if_absent_keeps_what_is_there(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.create_if_absent(spark, "dims_test", DIM_PRICES, path, ["as_of_date"])
    assert spark.table("dims_test").schema == DIM_PRICES
    prices(spark, "2000-01-03", ("A", 1.0)).write.insertInto("dims_test")
    tables.create_if_absent(spark, "dims_test", DIM_PRICES, path, ["as_of_date"])
    assert spark.table("dims_test").count() == 1
    spark.sql("DROP TABLE dims_test")


def test_publish_is_repeatable_and_replaces_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    first = prices(spark, "2000-01-03", ("A", 1.0), ("B", 2.0))
    for _ in range(2):
        tables.publish_partition(first, path, DIM_PRICES, day("2000-01-03"))
    tables.publish_partition(prices(spark, "2000-01-04", ("A", 1.0)), path, DIM_PRICES, day("2000-01-04"))
    assert len(stored(spark, path)) == 3
    tables.publish_partition(first.filter("ticker = 'B'"), path, DIM_PRICES, day("2000-01-03"))
    assert stored(spark, path) == [("2000-01-03", "B"), ("2000-01-04", "A")]


def test_publishing_nothing_empties_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = prices(spark, "2000-01-03", ("A", 1.0))
    tables.publish_partition(rows, path, DIM_PRICES, day("2000-01-03"))
    tables.publish_partition(rows.filter("false"), path, DIM_PRICES, day("2000-01-03"))
    assert stored(spark, path) == []


def test_a_failed_check_leaves_the_partition_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    on = day("2000-01-03")
    tables.publish_partition(prices(spark, "2000-01-03", ("A", 1.0)), path, DIM_PRICES, on)
    with pytest.raises(checks.DataQualityError, match="never"):
        tables.publish_partition(
            prices(spark, "2000-01-03", ("B", 1.0)), path, DIM_PRICES, on,
            checks=lambda rows: [rows.agg((F.count("*") < 0).alias("never"))],
        )
    assert stored(spark, path) == [("2000-01-03", "A")]
    assert len(os.listdir(f"{path}/_versions/as_of_date=2000-01-03")) == 1


def test_a_failing_job_leaves_the_partition_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    on = day("2000-01-03")
    good = prices(spark, "2000-01-03", ("A", 1.0))
    tables.publish_partition(good, path, DIM_PRICES, on)
    broken = good.withColumn("ticker", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(PySparkException):
        tables.publish_partition(broken, path, DIM_PRICES, on)
    assert stored(spark, path) == [("2000-01-03", "A")]


def test_read_partition_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    for on in ("2000-01-03", "2000-01-04"):
        tables.publish_partition(prices(spark, on, ("A", 1.0)), path, DIM_PRICES, day(on))
    one = read_partition(spark, path, DIM_PRICES, day("2000-01-04"))
    assert one.count() == 1
    assert all("as_of_date=2000-01-04" in file for file in one.inputFiles())
    assert read_partition(spark, path, DIM_PRICES, day("2000-01-05")).count() == 0


def test_bucketed_partition_reads_back(spark, tmp_path, make_arrays):
    path = str(tmp_path / "t")
    rows = make_arrays(*[(f"T{i}", "2000-01-03", [("2000-01-03", float(i))]) for i in range(20)])
    for _ in range(2):
        tables.publish_partition(
            rows.repartition(4, "ticker"), path, CUMULATIVE, day("2000-01-03"), buckets=4
        )
    back = read_bucketed_partition(spark, path, CUMULATIVE, day("2000-01-03"), 4)
    assert closes(back) == closes(rows)
    folder = partition_folder(spark, path, day("2000-01-03"))
    names = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    assert len(names) <= 4


PAGE = """{
  "status": "OK",
  "results": [
    {"execution_date": "2000-01-03", "split_from": 1, "split_to": 2, "ticker": "A"},
    {"execution_date": "2000-01-03", "split_from": 1, "split_to": 4, "ticker": "B"}
  ]
}"""


def one_line(page: str) -> str:
    return " ".join(page.split())


@pytest.mark.parametrize("text", [PAGE, PAGE + "\n" + PAGE, one_line(PAGE) + "\n" + one_line(PAGE)])
def test_whole_files_lose_no_document(spark, tmp_path, text):
    (tmp_path / "page.json").write_text(text)
    (tmp_path / "other.json").write_text(one_line(PAGE))
    read = json_feeds.read_splits(spark, str(tmp_path), day("2000-01-03"), day("2000-01-03"))
    assert read.count() == 2 * (text.count("status") + 1)


@pytest.mark.parametrize("lines", [True, False])
@pytest.mark.parametrize(
    "text", [one_line(PAGE)[:-30], one_line(PAGE).replace("2,", '"two",')], ids=["torn", "type"]
)
def test_unreadable_pages_raise(spark, tmp_path, text, lines):
    (tmp_path / "page.json").write_text(text)
    read = json_feeds.read_splits(
        spark, str(tmp_path), day("2000-01-03"), day("2000-01-03"), multi_line=not lines
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        read.collect()


def test_a_page_on_many_lines_is_not_json_lines(spark, tmp_path):
    (tmp_path / "page.json").write_text(PAGE)
    with pytest.raises(Exception, match="(?i)malformed"):
        json_feeds.read_splits(
            spark, str(tmp_path), day("2000-01-03"), day("2000-01-03"), multi_line=False
        ).collect()
