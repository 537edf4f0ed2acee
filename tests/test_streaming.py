import json
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from barweave.plans.intraday import apply_quotes
from barweave.schemas import CURRENT_DAY, METRICS
from barweave.sources.json_feeds import read_quotes, stream_quotes
from barweave.streaming.current_day import initialise, read_current, run_for, start_updates


@pytest.fixture
def current(spark):
    data = []
    for i in range(12):
        row = dict.fromkeys(CURRENT_DAY.fieldNames())
        row.update({name: 50.0 for name in METRICS}, ticker=f"T{i}", market_cap_description="x")
        data.append(tuple(row.values()))
    return spark.createDataFrame(data, CURRENT_DAY)


def write_pages(folder, parts, first=0):
    """Polls of 15 tickers, spread over ``parts`` files; the newest poll is in the first file."""
    os.makedirs(folder, exist_ok=True)
    polls = [
        {f"T{i}": {"c": 40 + i + 3 * poll, "t": f"2024-06-26T15:{59 - poll:02d}:00Z"} for i in range(15)}
        for poll in range(7)
    ]
    for part in range(parts):
        lines = [json.dumps({"bars": bars}) for bars in polls[part::parts]]
        with open(f"{folder}/page_{first + part}.json", "w") as file:
            file.write("\n".join(lines))


def rows(frame):
    return sorted(frame.collect(), key=lambda row: row["ticker"])


def run(spark, folder, **options):
    feed = stream_quotes(spark, f"{folder}/quotes", files_per_batch=1, multi_line=False)
    query = start_updates(feed, f"{folder}/current", f"{folder}/checkpoint", **options)
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_any_split_into_batches_gives_the_same_table(spark, tmp_path, current, parts):
    write_pages(f"{tmp_path}/quotes", parts)
    initialise(current, f"{tmp_path}/current")
    run(spark, tmp_path)
    at_once = apply_quotes(current, read_quotes(spark, f"{tmp_path}/quotes", multi_line=False))
    assert rows(read_current(spark, f"{tmp_path}/current")) == rows(at_once)
    assert len(os.listdir(f"{tmp_path}/current")) == parts + 1


def test_replaced_versions_go_after_their_time(spark, tmp_path, current):
    write_pages(f"{tmp_path}/quotes", 3)
    initialise(current, f"{tmp_path}/current")
    run(spark, tmp_path, keep_for=timedelta(0), compact_after=0)
    assert len(os.listdir(f"{tmp_path}/current")) == 1


def test_a_reader_of_the_first_version_outlives_five_batches(spark, tmp_path, current):
    write_pages(f"{tmp_path}/quotes", 5)
    initialise(current, f"{tmp_path}/current")
    reader = read_current(spark, f"{tmp_path}/current")
    run(spark, tmp_path)
    assert rows(reader) == rows(current)


def test_a_new_checkpoint_over_an_old_table_skips_no_batch(spark, tmp_path, current):
    table = f"{tmp_path}/current"
    initialise(current, table)
    write_pages(f"{tmp_path}/quotes", 1)
    run(spark, tmp_path)
    page = {"bars": {"T0": {"c": 70, "t": "2024-06-26T16:00:00Z"}}}
    os.makedirs(f"{tmp_path}/more")
    with open(f"{tmp_path}/more/page.json", "w") as file:
        file.write(json.dumps(page))
    for _ in range(2):
        feed = stream_quotes(spark, f"{tmp_path}/more", multi_line=False)
        start_updates(feed, table, f"{tmp_path}/other").awaitTermination(120)
        assert rows(read_current(spark, table))[0]["current_price"] == 70.0
    assert len(os.listdir(table)) == 3


def test_a_table_without_a_version_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="start the day"):
        read_current(spark, f"{tmp_path}/nothing")


def test_restart_continues_after_the_last_batch(spark, tmp_path, current):
    initialise(current, f"{tmp_path}/current")
    write_pages(f"{tmp_path}/quotes", 3)
    run(spark, tmp_path)
    before = rows(read_current(spark, f"{tmp_path}/current"))
    run(spark, tmp_path)
    assert rows(read_current(spark, f"{tmp_path}/current")) == before


def test_a_half_written_version_is_not_read_and_is_written_again(spark, tmp_path, current):
    table = f"{tmp_path}/current"
    initialise(current, table)
    write_pages(f"{tmp_path}/quotes", 1)
    os.makedirs(f"{table}/v=1_torn_0")
    with open(f"{table}/v=1_torn_0/part-0.parquet", "w") as file:
        file.write("torn")
    assert len(rows(read_current(spark, table))) == 12
    run(spark, tmp_path)
    assert rows(read_current(spark, table))[0]["current_price"] == 40.0


@pytest.mark.parametrize("files", [1, 3, 7])
@pytest.mark.parametrize("lines", [True, False])
def test_last_write_wins_in_any_batches(spark, tmp_path, current, files, lines):
    """The last file's older poll overwrites the newer ones; two files have the same time."""
    write_pages(f"{tmp_path}/quotes", 7)
    for number in range(7):
        os.utime(f"{tmp_path}/quotes/page_{number}.json", (1_000_000 + min(number, 5),) * 2)
    initialise(current, f"{tmp_path}/current")
    feed = stream_quotes(spark, f"{tmp_path}/quotes", files, multi_line=not lines, arrival=True)
    query = start_updates(
        feed, f"{tmp_path}/current", f"{tmp_path}/checkpoint", last_write_wins=True
    )
    query.awaitTermination(120)
    assert query.exception() is None
    found = read_current(spark, f"{tmp_path}/current")
    assert found.columns == CURRENT_DAY.fieldNames()
    assert rows(found)[0]["current_price"] == 40.0 + 18
    at_once = read_quotes(spark, f"{tmp_path}/quotes", not lines, arrival=True)
    assert rows(found) == rows(apply_quotes(current, at_once, True).drop("arrival"))


def test_last_write_wins_needs_the_arrival(spark, tmp_path, current):
    write_pages(f"{tmp_path}/quotes", 1)
    with pytest.raises(ValueError, match="arrival"):
        run(spark, tmp_path, last_write_wins=True)


def test_a_session_polls_until_its_time_is_up(spark, tmp_path, current):
    write_pages(f"{tmp_path}/quotes", 1)
    initialise(current, f"{tmp_path}/current")
    feed = stream_quotes(spark, f"{tmp_path}/quotes", multi_line=False)
    query = start_updates(
        feed, f"{tmp_path}/current", f"{tmp_path}/checkpoint", interval="1 second"
    )
    query.processAllAvailable()
    run_for(query, minutes=0.02)
    assert not query.isActive
    assert rows(read_current(spark, f"{tmp_path}/current"))[0]["current_price"] == 40.0


def folder_sizes(table):
    """name -> (rows, bytes) of each version and delta, in order."""
    sizes = {}
    for name in sorted(os.listdir(table), key=lambda n: int(n[2:].partition("_")[0])):
        files = [f for f in os.listdir(f"{table}/{name}") if f.endswith(".parquet")]
        sizes[name] = sum(os.path.getsize(f"{table}/{name}/{file}") for file in files)
    return sizes


@pytest.mark.parametrize("last_write_wins", [False, True])
@pytest.mark.parametrize("compact_after", [0, 2, 16])
def test_deltas_give_the_table_of_whole_versions(spark, tmp_path, current, compact_after, last_write_wins):
    """Seven batches, of which some change nothing and some have unknown tickers only."""
    os.makedirs(f"{tmp_path}/quotes")
    for number in range(7):
        names = [f"T{i}" for i in range(number, 15, 3)] if number != 4 else ["unknown"]
        bars = {n: {"c": 40 + number, "t": f"2024-06-26T15:{(number * 5) % 7:02d}:00Z"} for n in names}
        with open(f"{tmp_path}/quotes/page_{number}.json", "w") as file:
            file.write(json.dumps({"bars": bars}))
        os.utime(f"{tmp_path}/quotes/page_{number}.json", (1_000_000 + number,) * 2)
    initialise(current, f"{tmp_path}/current")
    feed = stream_quotes(
        spark, f"{tmp_path}/quotes", files_per_batch=1, multi_line=False, arrival=last_write_wins
    )
    query = start_updates(
        feed, f"{tmp_path}/current", f"{tmp_path}/checkpoint", last_write_wins,
        compact_after=compact_after,
    )
    query.awaitTermination(120)
    assert query.exception() is None
    at_once = read_quotes(spark, f"{tmp_path}/quotes", False, arrival=last_write_wins)
    expected = apply_quotes(current, at_once, last_write_wins).drop("arrival")
    assert rows(read_current(spark, f"{tmp_path}/current")) == rows(expected)
    kinds = "".join(name[0] for name in folder_sizes(f"{tmp_path}/current"))
    assert kinds == {0: "vvvvvvvv", 2: "vddvddvd", 16: "vddddddd"}[compact_after]


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    """A table of 200,000 rows and batches of three quotes."""
    row = dict.fromkeys(CURRENT_DAY.fieldNames())
    wide = spark.range(200_000).selectExpr(
        "concat('T', id) AS ticker", *[f"id * 1.5D AS {name}" for name in METRICS]
    )
    for name in row.keys() - set(wide.columns):
        wide = wide.withColumn(name, F.lit(None).cast(CURRENT_DAY[name].dataType))
    initialise(wide, f"{tmp_path}/current")
    write_pages(f"{tmp_path}/quotes", 3)
    run(spark, tmp_path)
    whole, *deltas = folder_sizes(f"{tmp_path}/current").values()
    assert len(deltas) == 3 and all(size < whole / 50 for size in deltas)
    found = read_current(spark, f"{tmp_path}/current")
    assert found.count() == 200_000
    assert found.filter("current_price IS NOT NULL").count() == 15


def test_a_reader_keeps_its_state_while_the_table_is_compacted(spark, tmp_path, current):
    write_pages(f"{tmp_path}/quotes", 3)
    initialise(current, f"{tmp_path}/current")
    run(spark, tmp_path)
    reader = read_current(spark, f"{tmp_path}/current")
    before = rows(reader)
    write_pages(f"{tmp_path}/quotes", 2, first=10)
    run(spark, tmp_path, compact_after=1)
    assert rows(reader) == before
    write_pages(f"{tmp_path}/quotes", 2, first=20)
    run(spark, tmp_path, compact_after=0, keep_for=timedelta(0))
    assert len(os.listdir(f"{tmp_path}/current")) == 1
    assert rows(read_current(spark, f"{tmp_path}/current")) == before
