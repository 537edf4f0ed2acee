"""Publishing by switching: old or new at every moment, snapshots, lost drivers."""

import os
from datetime import timedelta

import pytest
from conftest import day

from barweave.operators import checks
from barweave.schemas import DIM_PRICES
from barweave.sinks import folders, tables, versions
from barweave.sources.tables import (
    partition_dates,
    read_newest_partition,
    read_partition,
    read_partitions,
    read_table,
)

MONDAY, TUESDAY = day("2000-01-03"), day("2000-01-04")


def prices(spark, on, *tickers):
    data = [(ticker, 1.0, None, None, on) for ticker in tickers]
    return spark.createDataFrame(data, DIM_PRICES)


def publish(spark, path, on, *tickers, **options):
    tables.publish_partition(prices(spark, on, *tickers), path, DIM_PRICES, on, **options)


def stored(spark, path, at=None):
    rows = read_table(spark, path, DIM_PRICES, at).collect()
    return sorted((r["as_of_date"].isoformat(), r["ticker"]) for r in rows)


class Lost(BaseException):
    """The driver ends here; nothing catches it."""


STEPS = ("create", "delete", "modified", "children", "exists")


def test_lost_at_any_step_leaves_old_or_new(spark, tmp_path, monkeypatch):
    """Every call to the storage is stopped once, before it and after it is done."""
    seen = set()
    for moment in range(200):
        path = str(tmp_path / f"t{moment}")
        publish(spark, path, MONDAY, "old")
        publish(spark, path, TUESDAY, "other")
        calls = 0

        def counted(real):
            def call(*arguments):
                nonlocal calls
                calls += 1
                if calls == moment // 2 + 1 and moment % 2 == 0:
                    raise Lost
                result = real(*arguments)
                if calls == moment // 2 + 1:
                    raise Lost
                return result

            return call

        with monkeypatch.context() as patched:
            for name in STEPS:
                patched.setattr(folders, name, counted(getattr(folders, name)))
            lost = True
            try:
                publish(spark, path, MONDAY, "new", keep_for=timedelta(0))
                lost = False
            except Lost:
                pass
        found = stored(spark, path)
        assert found in (
            [("2000-01-03", "old"), ("2000-01-04", "other")],
            [("2000-01-03", "new"), ("2000-01-04", "other")],
        )
        seen.add(found[0][1])
        # The next run needs no repair, and clears away what the lost one left.
        publish(spark, path, MONDAY, "next", keep_for=timedelta(0))
        assert stored(spark, path) == [("2000-01-03", "next"), ("2000-01-04", "other")]
        assert len(os.listdir(f"{path}/_versions/as_of_date=2000-01-03")) == 1
        if not lost:
            break
    assert not lost and seen == {"old", "new"}


def test_a_job_lost_while_writing_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(spark, path, MONDAY, "old")
    with monkeypatch.context() as patched:
        patched.setattr(versions, "switch", lambda *_: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            publish(spark, path, MONDAY, "new")
    assert stored(spark, path) == [("2000-01-03", "old")]


def test_snapshots_are_read_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark, path, MONDAY, "A")
    publish(spark, path, TUESDAY, "B")
    before = versions.snapshot(spark, path)
    reading = read_table(spark, path, DIM_PRICES)
    publish(spark, path, MONDAY, "C")
    publish(spark, path, TUESDAY)
    assert stored(spark, path, before) == [("2000-01-03", "A"), ("2000-01-04", "B")]
    assert stored(spark, path, 1) == [("2000-01-03", "A")]
    assert stored(spark, path, 0) == []
    assert stored(spark, path) == [("2000-01-03", "C")]
    assert sorted(r["ticker"] for r in reading.collect()) == ["A", "B"]


def test_replaced_versions_go_after_their_time(spark, tmp_path):
    path = str(tmp_path / "t")
    for name in ("A", "B", "C"):
        publish(spark, path, MONDAY, name)
    folder = f"{path}/_versions/as_of_date=2000-01-03"
    assert len(os.listdir(folder)) == 3
    publish(spark, path, TUESDAY, "other", keep_for=timedelta(0))
    assert len(os.listdir(folder)) == 3  # another partition's are left
    publish(spark, path, MONDAY, "D", keep_for=timedelta(0))
    assert len(os.listdir(folder)) == 1
    assert [entry.number for entry in versions.log(spark, path)] == [4, 5]
    assert stored(spark, path) == [("2000-01-03", "D"), ("2000-01-04", "other")]


def test_partitions_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark, path, TUESDAY, "B")
    publish(spark, path, MONDAY, "A")
    assert partition_dates(spark, path) == [MONDAY, TUESDAY]
    assert [r["ticker"] for r in read_newest_partition(spark, path, DIM_PRICES).collect()] == ["B"]
    assert read_partitions(spark, path, DIM_PRICES, MONDAY, TUESDAY).count() == 2
    assert read_partitions(spark, path, DIM_PRICES, TUESDAY, TUESDAY).count() == 1
    assert read_partition(spark, path, DIM_PRICES, day("2000-01-05")).count() == 0


def test_a_failed_check_leaves_no_folder_and_no_entry(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark, path, MONDAY, "A")
    with pytest.raises(checks.DataQualityError):
        publish(
            spark, path, MONDAY, "B",
            checks=lambda rows: [rows.selectExpr("count(*) < 0 AS never")],
        )
    assert len(versions.log(spark, path)) == 1
    assert len(os.listdir(f"{path}/_versions/as_of_date=2000-01-03")) == 1


def test_an_entry_is_created_once(spark, tmp_path):
    path = str(tmp_path / "file")
    folders.create(spark, path)
    with pytest.raises(FileExistsError):
        folders.create(spark, path)


def test_measured_checks_need_no_second_read(spark, tmp_path, monkeypatch):
    """The same verdicts as over the stored rows, while nothing is read."""
    path = str(tmp_path / "t")
    whole = [checks.none_missing("ticker"), checks.none_missing("close_price_last_day")]
    monkeypatch.setattr(tables, "read_staged", lambda *_: pytest.fail("read again"))
    for buckets in (None, 2):
        rows = prices(spark, MONDAY, "A", "B")
        tables.publish_partition(rows, path, DIM_PRICES, MONDAY, measured=whole, buckets=buckets)
        tables.publish_partition(rows.limit(0), path, DIM_PRICES, TUESDAY, measured=whole)
        broken = rows.union(prices(spark, MONDAY, None))
        with pytest.raises(checks.DataQualityError, match="^ticker_is_not_null_check$"):
            tables.publish_partition(broken, path, DIM_PRICES, MONDAY, measured=whole, buckets=buckets)
        assert stored(spark, path) == [("2000-01-03", "A"), ("2000-01-03", "B")]
    monkeypatch.undo()
    with pytest.raises(checks.DataQualityError, match="ticker"):
        tables.replace_table(prices(spark, MONDAY, None), str(tmp_path / "u"), DIM_PRICES, measured=whole)


@pytest.mark.parametrize("source", ["rows", "files", "shuffle"])
def test_checks_of_a_table_without_rows_have_answers(spark, tmp_path, source):
    """Also where the write shuffles: nothing of an empty shuffle's input runs to its end."""
    rows = prices(spark, MONDAY)
    if source == "files":
        rows.write.parquet(str(tmp_path / "none"))
        rows = spark.read.schema(DIM_PRICES).parquet(str(tmp_path / "none"))
    if source == "shuffle":
        rows = prices(spark, MONDAY, "A").filter("ticker > 'A'").repartition("ticker")
    whole = [checks.none_missing("ticker")]
    path, first = str(tmp_path / "t"), prices(spark, MONDAY, "A")
    for written, found in ((first, ["A"]), (rows, [])):
        tables.replace_table(
            written, path, DIM_PRICES, partition_by=["as_of_date"], sort_by=["ticker"], measured=whole
        )
        assert [ticker for _, ticker in stored(spark, path)] == found
    with pytest.raises(checks.DataQualityError, match="ticker_is_not_null_check"):
        tables.replace_table(
            prices(spark, MONDAY, None), path, DIM_PRICES, partition_by=["as_of_date"], measured=whole
        )
    tables.publish_partition(rows, str(tmp_path / "p"), DIM_PRICES, MONDAY, measured=whole)
    assert stored(spark, str(tmp_path / "p")) == []
