"""One query per operator. Each reads the given tables in full."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from barweave.functions.calendar import epoch_nanos_to_date, parse_quote_time, previous_weekday
from barweave.functions.market_cap import market_cap_bucket
from barweave.operators import bars as bar_ops
from barweave.operators import checks
from barweave.operators.details import latest_details, ticker_details
from barweave.operators.leaderboard import change_by_cap, leaderboard, row_count
from barweave.operators.merge import merge_matched
from barweave.operators.quotes import latest_quote, quote_metrics, tradable_symbols, valid_quotes
from barweave.operators.split_events import active_splits, merge_events, split_events
from barweave.operators.splits import adjust_bars, cumulative_factors, match_factors, rank_splits
from barweave.plans.daily import (
    Feeds,
    Tables,
    run_days,
    stage_months,
    staged_bars,
    start_from_files,
    start_history,
)
from barweave.plans.history import (
    apply_late_splits,
    backfill_cumulative,
    daily_step,
    previous_arrays,
    split_tickers,
    unsplit_tickers,
)
from barweave.plans.intraday import apply_quotes
from barweave.plans.reference_prices import dim_prices, init_current_day
from barweave.schemas import (
    BARS_BY_MONTH,
    CUMULATIVE,
    CURRENT_DAY,
    DIM_PRICES,
    PRICE_ELEMENT,
    SPLIT_LEDGER,
    TICKER_DETAILS,
    UPDATED_COLUMNS,
)
from barweave.session import work_dir
from barweave.sinks import versions
from barweave.sinks.tables import (
    create_if_absent,
    overwrite_partitions,
    publish_partition,
    replace_table,
)
from barweave.sources import json_feeds
from barweave.sources.bars import months_between, read_daily_bars, read_month_bars
from barweave.sources.landed import landed_files, page_addresses
from barweave.sources.tables import (
    newest_date,
    read_newest_partition,
    read_partition,
    read_table,
    reference_columns,
)
from barweave.streaming.current_day import initialise, read_current, start_updates

from . import landing, views
from .views import DAY, SUNDAY

EVE = DAY - timedelta(days=1)
LATE_FROM = date(2000, 1, 1)  # splits executed after this day count as late

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared steps ---------------------------------------------------------------------------


def _known_splits(spark, sf_dir, until: date):
    return views.splits(spark, sf_dir).filter(F.col("execution_date") <= until.isoformat())


def _eve_arrays(spark, sf_dir):
    return backfill_cumulative(
        views.bars(spark, sf_dir), _known_splits(spark, sf_dir, EVE), as_of=EVE
    )


def _day_arrays(spark, sf_dir):
    return daily_step(
        _eve_arrays(spark, sf_dir),
        views.bars(spark, sf_dir),
        views.day_splits(spark, sf_dir),
        DAY,
    )


def _details(spark, sf_dir):
    return views.details(spark, sf_dir).withColumn(
        "market_cap_description", market_cap_bucket(F.col("market_cap"))
    )


def _current(spark, sf_dir):
    prices = dim_prices(_day_arrays(spark, sf_dir), DAY)
    return init_current_day(prices, _details(spark, sf_dir), DAY)


def _updated(spark, sf_dir):
    return apply_quotes(_current(spark, sf_dir), views.quote_feed(spark, sf_dir))


def _updates(spark, sf_dir):
    utc = F.concat(F.col("t").cast("string"), F.lit("Z")).cast("timestamp")
    valid = valid_quotes(views.quotes(spark, sf_dir)).select(
        "ticker",
        F.col("c").alias("current_price"),
        utc.alias("last_updated_datetime"),
        "event_id",
    )
    return latest_quote(valid, "event_id")


def _utc(time: Column) -> Column:
    """UTC wall-clock time without a zone, whatever the session's zone: SQL's TIMESTAMP."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), time.cast("timestamp_ntz"))


def _zoneless(frame: DataFrame) -> DataFrame:
    return frame.withColumn("last_updated_datetime", _utc(F.col("last_updated_datetime")))


_flat = bar_ops.positioned_prices


# ---- sources --------------------------------------------------------------------------------


def src_daily_csv(spark, sf_dir):
    root = work_dir(spark, "daily-csv")
    landing.land_days(views.bars(spark, sf_dir), root, [DAY])
    return read_daily_bars(spark, root, DAY)


def src_backfill_csv(spark, sf_dir):
    root = work_dir(spark, "month-csv")
    bars = views.bars(spark, sf_dir)
    landing.land_months(bars, root)
    first, last = bars.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    return read_month_bars(spark, root, months_between(first, last), landing.YEAR_MONTH)


def src_weekend_empty(spark, sf_dir):
    """Friday to Monday: the weekend's files exist but are not loaded."""
    root = work_dir(spark, "weekend-csv")
    days = [DAY + timedelta(days=offset) for offset in range(1, 5)]
    landing.land_days(views.bars(spark, sf_dir), root, days)
    loaded = read_daily_bars(spark, root, days[0])
    for day in days[1:]:
        loaded = loaded.unionByName(read_daily_bars(spark, root, day))
    return loaded


def _landed_splits(spark, sf_dir):
    path = work_dir(spark, "splits")
    feed = views.splits(spark, sf_dir).unionByName(views.day_splits(spark, sf_dir))
    landing.land_splits(feed, path)
    return path


def src_splits_json(spark, sf_dir):
    path = _landed_splits(spark, sf_dir)
    return json_feeds.read_splits(spark, path, DAY, DAY, multi_line=False)


def src_splits_range(spark, sf_dir):
    path = _landed_splits(spark, sf_dir)
    return json_feeds.read_splits(spark, path, date(1997, 1, 1), DAY, multi_line=False)


def src_splits_empty(spark, sf_dir):
    path = _landed_splits(spark, sf_dir)
    before = date(1995, 6, 1)  # no split that early
    return json_feeds.read_splits(spark, path, before, before, multi_line=False)


def _landed_documents(spark, sf_dir):
    """Lookups of tickers with a negative balance failed: their documents have no results."""
    path = work_dir(spark, "documents")
    suppliers = views.table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    result = F.struct(
        F.concat(F.lit("S"), key).alias("ticker"),
        F.lit("S").alias("ticker_root"),
        F.col("s_name").alias("name"),
        (F.col("s_acctbal") > 1000).alias("active"),
        F.lit("usd").alias("currency_name"),
        F.lit("us").alias("locale"),
        F.when(F.col("s_nationkey") < 20, "stocks").otherwise("otc").alias("market"),
        views.market_cap().alias("market_cap"),
        F.concat(F.lit("X"), F.col("s_nationkey").cast("string")).alias("primary_exchange"),
        F.lit("RETAIL").alias("sic_description"),
        F.col("s_suppkey").alias("weighted_shares_outstanding"),
    )
    found = F.col("s_acctbal") >= 0
    documents = suppliers.select(
        F.when(found, "OK").otherwise("NOT_FOUND").alias("status"),
        F.when(found, result).alias("results"),
    )
    landing.land_documents(documents, path)
    return json_feeds.read_ticker_documents(spark, path, multi_line=False)


def src_ticker_details(spark, sf_dir):
    return _landed_documents(spark, sf_dir)


def src_quotes(spark, sf_dir):
    path = work_dir(spark, "quotes")
    landing.land_quotes(views.quote_feed(spark, sf_dir), path)
    return json_feeds.read_quotes(spark, path, multi_line=False)


def filter_symbols(spark, sf_dir):
    """Stocks are suppliers, currency pairs are customers."""
    path = work_dir(spark, "assets")
    stocks = views.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol")
    )
    pairs = views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit("/USD")).alias("symbol")
    )
    landing.land_assets(stocks.unionByName(pairs).withColumn("status", F.lit("active")), path)
    return tradable_symbols(json_feeds.read_assets(spark, path, multi_line=False))


def scan_partition(spark, sf_dir):
    """Ticker details with two date partitions, of which one is read."""
    path = work_dir(spark, "details-table")
    rows = _details(spark, sf_dir)
    schema = StructType([field for field in TICKER_DETAILS if field.name in rows.columns])
    replace_table(rows, path, schema, ["as_of_date"], ["market_cap_description"])
    return read_partition(spark, path, schema, date(2000, 6, 10))


def scan_projection(spark, sf_dir):
    path = work_dir(spark, "current-table")
    _updated(spark, sf_dir).write.parquet(path)
    return reference_columns(spark.read.parquet(path))


# ---- sinks ----------------------------------------------------------------------------------


def sink_dynamic_overwrite(spark, sf_dir):
    """All bars by year; then only the year 2000 is replaced, by split-adjusted bars."""
    path = work_dir(spark, "bars-by-year")
    bars, year = views.bars(spark, sf_dir), F.year("snapshot_date").alias("year")
    ticker, stored_year = StructField("ticker", StringType()), StructField("year", IntegerType())
    schema = StructType([ticker, *PRICE_ELEMENT, stored_year])
    replace_table(bars.select("*", year), path, schema, ["year"], ["ticker"])
    adjusted = adjust_bars(bars, views.splits(spark, sf_dir)).select("*", year)
    overwrite_partitions(
        adjusted.filter(F.col("year") == 2000), path, schema, ["year"], ["ticker"]
    )
    return read_table(spark, path, schema)


def publish_partition_twice(spark, sf_dir):
    """The day is published twice, the day before is published and then emptied."""
    path = work_dir(spark, "dim-table")
    eve = dim_prices(_eve_arrays(spark, sf_dir), EVE)
    today = dim_prices(_day_arrays(spark, sf_dir), DAY)
    publish_partition(eve, path, DIM_PRICES, EVE)
    publish_partition(today, path, DIM_PRICES, DAY)
    publish_partition(today, path, DIM_PRICES, DAY)
    publish_partition(eve.filter(F.lit(False)), path, DIM_PRICES, EVE)
    return read_table(spark, path, DIM_PRICES)


def wap_publish(spark, sf_dir):
    """A checked publish of two days, then a failing one that must change nothing."""
    path = work_dir(spark, "cumulative-table")
    publish_partition(_eve_arrays(spark, sf_dir), path, CUMULATIVE, EVE)
    before = read_partition(spark, path, CUMULATIVE, EVE)
    stepped = daily_step(
        before, views.bars(spark, sf_dir), views.day_splits(spark, sf_dir), DAY
    )

    def growth(rows):
        return [checks.check_growth(rows, before)]

    publish_partition(stepped, path, CUMULATIVE, DAY, growth, sort_by=["ticker"])
    today = read_partition(spark, path, CUMULATIVE, DAY)
    doubled = today.unionByName(today)
    try:
        publish_partition(doubled, path, CUMULATIVE, DAY, growth)
    except checks.DataQualityError:
        return _flat(read_table(spark, path, CUMULATIVE))
    raise AssertionError("doubling the rows passed the growth check")


def merge_matched_update(spark, sf_dir):
    current = _current(spark, sf_dir)
    updates = quote_metrics(_updates(spark, sf_dir), current)
    return _zoneless(merge_matched(current, updates, "ticker", UPDATED_COLUMNS))


# ---- filters and scalar functions -----------------------------------------------------------


def filter_valid_bars(spark, sf_dir):
    """Bars by their change since the low, so that bars without one are invalid."""
    bars = views.bars(spark, sf_dir)
    return bar_ops.valid_bars(bars.withColumn("low", F.col("close") - F.col("low")))


def filter_quotes(spark, sf_dir):
    return valid_quotes(views.quotes(spark, sf_dir)).select("ticker", "c", "event_id")


def market_cap_buckets(spark, sf_dir):
    return _details(spark, sf_dir).select(
        "ticker", "as_of_date", "market_cap_description"
    )


def epoch_to_date(spark, sf_dir):
    return views.bars(spark, sf_dir).select(
        "ticker",
        "window_start",
        epoch_nanos_to_date(F.col("window_start")).alias("snapshot_date"),
    )


def prev_weekday(spark, sf_dir):
    ordered = F.to_date("o_orderdate")
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", previous_weekday(ordered).alias("prev_weekday")
    )


def parse_quote_ts(spark, sf_dir):
    """Times with and without fractional seconds, and text that is no time."""
    feed = views.quote_feed(spark, sf_dir)
    whole = F.concat(F.substring("t", 1, 19), F.lit("Z"))
    return feed.select(
        "event_id",
        _utc(parse_quote_time(F.col("t"))).alias("t"),
        _utc(parse_quote_time(whole)).alias("t_seconds"),
        _utc(parse_quote_time(F.col("ticker"))).alias("t_none"),
    )


# ---- splits ---------------------------------------------------------------------------------


def split_rank(spark, sf_dir):
    return rank_splits(views.splits(spark, sf_dir))


def split_factors(spark, sf_dir):
    return cumulative_factors(views.splits(spark, sf_dir))


def split_asof_map(spark, sf_dir):
    mapped = match_factors(views.bars(spark, sf_dir), views.splits(spark, sf_dir))
    return mapped.select("ticker", "snapshot_date", "split_from", "split_to")


def adjusted_bars(spark, sf_dir):
    return adjust_bars(views.bars(spark, sf_dir), views.splits(spark, sf_dir))


# ---- arrays ---------------------------------------------------------------------------------


def attach_max_date(spark, sf_dir):
    return bar_ops.with_max_date(views.bars(spark, sf_dir)).select(
        "ticker", "snapshot_date", "close", "as_of_date"
    )


def price_array_agg(spark, sf_dir):
    dated = bar_ops.with_max_date(views.bars(spark, sf_dir))
    return _flat(bar_ops.price_arrays(dated, "ticker", "as_of_date"))


def today_arrays(spark, sf_dir):
    arrays = bar_ops.today_arrays(views.bars(spark, sf_dir))
    return _flat(arrays.withColumnRenamed("snapshot_date", "as_of_date"))


def unnest_prices(spark, sf_dir):
    return bar_ops.unnest_prices(_eve_arrays(spark, sf_dir))


def trim_year(spark, sf_dir):
    """All history up to the day before, trimmed to make room for the day."""
    until = views.bars(spark, sf_dir).filter(F.col("snapshot_date") <= F.lit(EVE))
    arrays = bar_ops.price_arrays(until, "ticker").withColumn("as_of_date", F.lit(EVE))
    return _flat(previous_arrays(arrays, DAY))


def yesterday_split_adjust(spark, sf_dir):
    return _flat(
        split_tickers(_eve_arrays(spark, sf_dir), views.day_splits(spark, sf_dir), DAY)
    )


def yesterday_no_split(spark, sf_dir):
    return _flat(
        unsplit_tickers(_eve_arrays(spark, sf_dir), views.day_splits(spark, sf_dir), DAY)
    )


def cumulative_backfill(spark, sf_dir):
    return _flat(
        backfill_cumulative(views.bars(spark, sf_dir), views.splits(spark, sf_dir))
    )


def cumulative_daily(spark, sf_dir):
    return _flat(_day_arrays(spark, sf_dir))


def late_split_fix(spark, sf_dir):
    """History built without the splits of 2000, which then arrive late."""
    known = _known_splits(spark, sf_dir, LATE_FROM)
    history = backfill_cumulative(views.bars(spark, sf_dir), known, as_of=EVE)
    feed = _known_splits(spark, sf_dir, EVE)
    return _flat(apply_late_splits(history, feed, known))


# ---- reference prices, quotes ---------------------------------------------------------------


def dim_daily_prices(spark, sf_dir):
    return dim_prices(_day_arrays(spark, sf_dir), DAY)


def dim_daily_prices_weekend(spark, sf_dir):
    arrays = backfill_cumulative(
        views.bars(spark, sf_dir), _known_splits(spark, sf_dir, SUNDAY), as_of=SUNDAY
    )
    return dim_prices(arrays, SUNDAY)


def dim_daily_prices_latest(spark, sf_dir):
    return dim_prices(_day_arrays(spark, sf_dir), DAY, last_close="latest")


def ticker_detail_table(spark, sf_dir):
    return ticker_details(_landed_documents(spark, sf_dir), DAY)


def latest_detail_rows(spark, sf_dir):
    return latest_details(_details(spark, sf_dir)).select(
        "ticker", "as_of_date", "market_cap_description"
    )


def current_day_init(spark, sf_dir):
    return _zoneless(_current(spark, sf_dir))


def latest_quote_rows(spark, sf_dir):
    return _zoneless(_updates(spark, sf_dir))


def quote_metric_rows(spark, sf_dir):
    prices = dim_prices(_day_arrays(spark, sf_dir), DAY)
    return _zoneless(quote_metrics(_updates(spark, sf_dir), prices))


def quotes_applied(spark, sf_dir):
    return _zoneless(_updated(spark, sf_dir))


# ---- dashboard ------------------------------------------------------------------------------

# Board name -> (metric, ascending).
BOARDS = {
    "top50_above_last_day": ("m_price_change_last_day_pct", False),
    "top50_below_last_day": ("m_price_change_last_day_pct", True),
    "top50_below_90d": ("m_price_change_last_90_days_pct", True),
    "top50_above_90d": ("m_price_change_last_90_days_pct", False),
    "top50_above_365d": ("m_price_change_last_365_days_pct", False),
    "top50_below_365d": ("m_price_change_last_365_days_pct", True),
}


def _board(name: str) -> Query:
    metric, ascending = BOARDS[name]
    return lambda spark, sf_dir: leaderboard(_updated(spark, sf_dir), metric, ascending)


def top50_by_cap(spark, sf_dir):
    return leaderboard(
        _updated(spark, sf_dir),
        *BOARDS["top50_above_365d"],
        caps=["Mega Cap", "Large Cap", "Not Provided"],
    )


def top50_cross_filter(spark, sf_dir):
    """The tickers of one chart, selected, filter another."""
    current = _updated(spark, sf_dir)
    selected = leaderboard(current, *BOARDS["top50_above_365d"])
    return leaderboard(current, *BOARDS["top50_below_90d"], tickers=selected)


def changes_by_cap(spark, sf_dir):
    return change_by_cap(_updated(spark, sf_dir))


def dataset_count(spark, sf_dir):
    return row_count(_updated(spark, sf_dir))


# ---- data quality ---------------------------------------------------------------------------


def dq_bars_not_null(spark, sf_dir):
    return checks.check_bars(views.bars(spark, sf_dir))


def dq_splits(spark, sf_dir):
    return checks.check_splits(views.splits(spark, sf_dir))


def dq_growth(spark, sf_dir):
    return checks.check_growth(_day_arrays(spark, sf_dir), _eve_arrays(spark, sf_dir))


def dq_growth_first_day(spark, sf_dir):
    """Before the first bar there is nothing: 0 < 0 fails."""
    bars = views.bars(spark, sf_dir)
    none = bars.filter(F.col("window_start") < 0)
    return checks.check_growth(none, none)


def dq_report(spark, sf_dir):
    """One row per check. The bars are of many days, so the one-day check fails."""
    bars, splits = views.bars(spark, sf_dir), views.splits(spark, sf_dir)
    reports = [
        ("bars", checks.check_bars(bars)),
        ("bars", checks.check_unique(bars)),
        ("bars", checks.check_day(bars, DAY)),
        ("splits", checks.check_splits(splits)),
    ]
    rows = [
        checks.check_report(check).withColumn("table_name", F.lit(name))
        for name, check in reports
    ]
    return reduce(DataFrame.unionByName, rows)


def dq_empty_passes(spark, sf_dir):
    bars = views.bars(spark, sf_dir)
    return checks.check_bars(bars.filter(F.col("window_start") < 0))


# ---- over time ------------------------------------------------------------------------------


def _catch_up(buckets: int | None) -> Query:
    def run(spark, sf_dir):
        root = work_dir(spark, "catch-up")
        bars, splits = views.bars(spark, sf_dir), views.splits(spark, sf_dir)
        days = [DAY + timedelta(days=offset) for offset in range(3)]
        landing.land_days(bars, f"{root}/bars", days)
        landing.land_splits(splits.unionByName(views.day_splits(spark, sf_dir)), f"{root}/splits")
        feeds = Feeds(f"{root}/bars", f"{root}/splits", split_lines=True)
        tables = Tables(f"{root}/tables", buckets)
        start_history(tables, bars, _known_splits(spark, sf_dir, EVE), EVE)
        run_days(spark, tables, feeds, days[0], days[-1])
        return read_table(spark, tables.prices, DIM_PRICES)

    return run


def catchup_late_split(spark, sf_dir):
    """The splits of 2000 land only after the first day was run; the second applies them."""
    root = work_dir(spark, "late-split")
    bars, splits = views.bars(spark, sf_dir), views.splits(spark, sf_dir)
    days = [DAY, DAY + timedelta(days=1)]
    landing.land_days(bars, f"{root}/bars", days)
    executed = F.col("execution_date")
    is_late = (executed > LATE_FROM.isoformat()) & (executed <= EVE.isoformat())
    in_time = splits.filter(~is_late).unionByName(views.day_splits(spark, sf_dir))
    landing.land_splits(in_time, f"{root}/splits/in-time")
    feeds = Feeds(f"{root}/bars", f"{root}/splits/*", split_lines=True)
    tables = Tables(f"{root}/tables")
    start_history(tables, bars, _known_splits(spark, sf_dir, LATE_FROM), EVE)
    run_days(spark, tables, feeds, days[0], days[0])
    landing.land_splits(splits.filter(is_late), f"{root}/splits/late")
    run_days(spark, tables, feeds, days[1], days[1])
    return _flat(tables.arrays_of(spark, days[1]))


def _fold_into_year(spark, sf_dir, land_more) -> DataFrame:
    """Two days of the catch-up; between them ``land_more(splits, root)`` lands more pages."""
    root = work_dir(spark, "relanded-split")
    bars = views.bars(spark, sf_dir)
    splits = views.splits(spark, sf_dir).unionByName(views.day_splits(spark, sf_dir))
    days = [DAY, DAY + timedelta(days=1)]
    landing.land_days(bars, f"{root}/bars", days)
    landing.land_splits(splits, f"{root}/splits/first")
    feeds = Feeds(f"{root}/bars", f"{root}/splits/*", split_lines=True)
    tables = Tables(f"{root}/tables")
    start_history(tables, bars, _known_splits(spark, sf_dir, EVE), EVE)
    run_days(spark, tables, feeds, days[0], days[0])
    land_more(splits, f"{root}/splits")
    run_days(spark, tables, feeds, days[1], days[1])
    return _flat(tables.arrays_of(spark, days[1]))


def catchup_relanded_split(spark, sf_dir):
    """Every page lands again before the second day, twice and under other names; nothing of it is
    a new event."""

    def again(splits, root):
        landing.land_splits(splits.orderBy("ticker"), f"{root}/again")
        landing.land_splits(splits.orderBy(F.desc("execution_date")).unionAll(splits), f"{root}/twice")

    return _fold_into_year(spark, sf_dir, again)


def catchup_withdrawn_split(spark, sf_dir):
    """Before the second day the splits of 2000 up to the eve are withdrawn, after which the first
    pages land again; the splits of the day itself stay."""

    def withdrawn(splits, root):
        executed = F.col("execution_date")
        gone = splits.filter((executed > LATE_FROM.isoformat()) & (executed <= EVE.isoformat()))
        landing.land_splits(gone.withColumn("withdrawn", F.lit(True)), f"{root}/withdrawn")
        landing.land_splits(splits, f"{root}/again")

    return _fold_into_year(spark, sf_dir, withdrawn)


def split_ledger(spark, sf_dir):
    """Splits with ids, of which some are corrected to 1:3 and some withdrawn, with copies of the
    first pages landed last: the ones that hold."""
    root = work_dir(spark, "split-ledger")
    number = F.col("ticker").substr(2, 9).cast("int")
    splits = views.splits(spark, sf_dir).withColumn(
        "id", F.concat_ws("-", "ticker", "execution_date")
    )
    corrected = splits.filter(number % 3 == 0).withColumns(
        {"split_from": F.lit(1.0), "split_to": F.lit(3.0)}
    )
    withdrawn = splits.filter(number % 5 == 0).withColumn("withdrawn", F.lit(True))
    landed = {"1-first": splits, "2-corrected": corrected, "3-withdrawn": withdrawn, "4-first": splits}
    ledger = spark.createDataFrame([], SPLIT_LEDGER)
    for turn, (name, rows) in enumerate(landed.items()):
        landing.land_splits(rows, f"{root}/{name}")
        on = EVE + timedelta(days=turn)
        pages = json_feeds.read_split_pages(spark, f"{root}/{name}", multi_line=False)
        files = landed_files(spark, f"{root}/{name}")
        ledger = merge_events(ledger, split_events(pages, on), files, on)
        ledger = ledger.withColumn("as_of_date", F.lit(on))
    return active_splits(ledger)


def src_split_documents(spark, sf_dir):
    """Whole documents of many elements, several a file, in one chain that is proved whole."""
    root = work_dir(spark, "split-documents")
    landing.land_split_documents(views.splits(spark, sf_dir), root)
    addresses = page_addresses(json_feeds.read_split_pages(spark, root))
    checks.run_checks(checks.check_chains(addresses, addresses.limit(0)))
    return json_feeds.read_splits(spark, root, date(1996, 1, 1), DAY)


def backfill_from_files(spark, sf_dir):
    """All months land as files; the staging is begun, left, and finished by the backfill, after
    which one month is staged again: from files to arrays, and on to the next day."""
    root = work_dir(spark, "month-files")
    bars = views.bars(spark, sf_dir)
    landing.land_months(bars, f"{root}/bars")
    landing.land_splits(views.splits(spark, sf_dir), f"{root}/splits")
    feeds = Feeds(f"{root}/bars", f"{root}/splits", split_lines=True)
    tables = Tables(f"{root}/tables")
    months = months_between(EVE - timedelta(days=364), EVE)
    stage_months(spark, tables, feeds.bars, months[:5], landing.YEAR_MONTH)
    start_from_files(spark, tables, feeds, EVE, landing.YEAR_MONTH)
    stage_months(spark, tables, feeds.bars, months[3:4], landing.YEAR_MONTH, again=True)
    start_from_files(spark, tables, feeds, EVE, landing.YEAR_MONTH)
    return _flat(tables.arrays_of(spark, EVE))


def attach_staged_max_date(spark, sf_dir):
    """The newest date of the staged months, found in the newest month alone, beside every bar."""
    root = work_dir(spark, "newest-date")
    bars = views.bars(spark, sf_dir).filter(F.col("snapshot_date") <= F.lit(EVE))
    landing.land_months(bars, f"{root}/bars")
    tables = Tables(f"{root}/tables")
    months = months_between(EVE - timedelta(days=60), EVE)
    stage_months(spark, tables, f"{root}/bars", months, landing.YEAR_MONTH)
    newest = newest_date(spark, tables.staged_months, BARS_BY_MONTH, "snapshot_date", "month")
    staged = staged_bars(spark, tables, months[0], EVE)
    return bar_ops.with_max_date(staged, newest).select(
        "ticker", "snapshot_date", "close", "as_of_date"
    )


def publish_snapshot(spark, sf_dir):
    """Two days are published, then one is replaced and one emptied; the first state is read after
    that, beside the last."""
    path = work_dir(spark, "snapshot-table")
    eve = dim_prices(_eve_arrays(spark, sf_dir), EVE)
    today = dim_prices(_day_arrays(spark, sf_dir), DAY)
    publish_partition(eve, path, DIM_PRICES, EVE)
    publish_partition(today, path, DIM_PRICES, DAY)
    before = versions.snapshot(spark, path)
    publish_partition(today.filter("close_price_last_day > 30000"), path, DIM_PRICES, DAY)
    publish_partition(eve.limit(0), path, DIM_PRICES, EVE)
    first = read_table(spark, path, DIM_PRICES, before).withColumn("state", F.lit("first"))
    return first.unionByName(
        read_table(spark, path, DIM_PRICES).withColumn("state", F.lit("last"))
    )


def stream_current_day(spark, sf_dir):
    """Quote files arrive a few at a time; the table ends as if all had come at once."""
    root = work_dir(spark, "stream")
    landing.land_quotes(views.quote_feed(spark, sf_dir).repartition(4), f"{root}/quotes")
    initialise(_current(spark, sf_dir), f"{root}/current")
    feed = json_feeds.stream_quotes(spark, f"{root}/quotes", files_per_batch=2, multi_line=False)
    start_updates(feed, f"{root}/current", f"{root}/checkpoint").awaitTermination()
    return _zoneless(read_current(spark, f"{root}/current"))


def stream_last_write_wins(spark, sf_dir):
    """Quotes land in five polls, by event and not by time; the last to arrive stays, two files a
    batch."""
    root = work_dir(spark, "arrivals")
    feed = views.quote_feed(spark, sf_dir)
    for poll in range(5):
        own = feed.filter(F.col("event_id") % 5 == poll).repartition(3, "ticker")
        landing.land_quotes(own, f"{root}/quotes/poll={poll}")
    initialise(_current(spark, sf_dir), f"{root}/current")
    feed = json_feeds.stream_quotes(
        spark, f"{root}/quotes/*", files_per_batch=2, multi_line=False, arrival=True
    )
    updates = start_updates(feed, f"{root}/current", f"{root}/checkpoint", last_write_wins=True)
    updates.awaitTermination()
    return _zoneless(read_current(spark, f"{root}/current"))


# ---- evidence: what these check can fail --------------------------------------------------------


def src_daily_among_days(spark, sf_dir):
    """A week of files lands; one day's are read."""
    root = work_dir(spark, "week-csv")
    days = [DAY + timedelta(days=offset) for offset in range(-3, 2)]
    landing.land_days(views.bars(spark, sf_dir), root, days)
    return read_daily_bars(spark, root, EVE)


def _by_part(rows: DataFrame, part: Column, check) -> DataFrame:
    """The check over all rows, and over those of each part, which differ in what they break."""
    found = [check(rows).withColumn("part", F.lit(-1))]
    for number in range(4):
        own = rows.filter(F.pmod(part, F.lit(4)) == number)
        found.append(check(own).withColumn("part", F.lit(number)))
    return reduce(DataFrame.unionByName, found)


def dq_bars_broken(spark, sf_dir):
    """Bars that lack a field, another one in each part; whole ones in the last."""
    bars = views.bars(spark, sf_dir)
    part = F.pmod("transactions", F.lit(4))

    def lacking(name, number):
        return F.when(part != number, F.col(name)).alias(name)

    broken = bars.withColumns(
        {"close": lacking("close", 0), "volume": lacking("volume", 1), "low": lacking("low", 1),
         "snapshot_date": lacking("snapshot_date", 2)}
    )
    return _by_part(broken, F.col("transactions"), checks.check_bars)


def dq_splits_broken(spark, sf_dir):
    """Splits without a ratio, with one of zero, and without a ticker, in parts."""
    number = F.col("ticker").substr(2, 9).cast("int")
    part = F.pmod(number, F.lit(4))
    splits = views.splits(spark, sf_dir).select(
        "execution_date",
        F.when(part != 0, F.col("split_from")).alias("split_from"),
        F.when(part == 1, F.lit(0.0)).otherwise(F.col("split_to")).alias("split_to"),
        F.when(part != 2, F.col("ticker")).alias("ticker"),
        number.alias("number"),
    )
    return _by_part(splits, F.col("number"), checks.check_splits)


def _top5(ascending: bool) -> Query:
    metric = "m_price_change_last_365_days_pct"
    return lambda spark, sf_dir: leaderboard(_updated(spark, sf_dir), metric, ascending, n=5)


def board_updated_between(spark, sf_dir):
    """The board of the tickers last updated near the end of the quotes, but not at it."""
    times = F.unix_micros(F.concat(F.col("t").cast("string"), F.lit("Z")).cast("timestamp"))
    first, last = views.quotes(spark, sf_dir).agg(F.min(times), F.max(times)).first()
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    between = [
        start + timedelta(microseconds=micros)
        for micros in ((first + 31 * last) // 32, (first + 255 * last) // 256)
    ]
    metric = "m_price_change_last_365_days_pct"
    return leaderboard(_updated(spark, sf_dir), metric, False, updated=tuple(between))


def create_table_once(spark, sf_dir):
    """A typed, partitioned table is created twice; what was inserted before stays."""
    path, name = work_dir(spark, "typed-table"), f"typed_{uuid.uuid4().hex}"
    details = views.details(spark, sf_dir)
    try:
        for on in (date(2000, 6, 1), date(2000, 6, 10)):
            create_if_absent(spark, name, details.schema, path, ["as_of_date"])
            details.filter(F.col("as_of_date") == F.lit(on)).write.insertInto(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return read_table(spark, path, details.schema)


def replace_whole_table(spark, sf_dir):
    """The current-day table is replaced by the start of the day, whatever stood in it."""
    path = work_dir(spark, "current-table")
    replace_table(_updated(spark, sf_dir), path, CURRENT_DAY)
    replace_table(_current(spark, sf_dir), path, CURRENT_DAY)
    return _zoneless(read_table(spark, path, CURRENT_DAY))


def latest_details_partitioned(spark, sf_dir):
    """The newest snapshot by its partition's name: no other is listed or read."""
    path = work_dir(spark, "details-table")
    details = views.details(spark, sf_dir)
    overwrite_partitions(details, path, details.schema, ["as_of_date"])
    return read_newest_partition(spark, path, details.schema)


QUERIES: dict[str, Query] = {
    "src_daily_csv": src_daily_csv,
    "src_backfill_csv": src_backfill_csv,
    "src_weekend_empty": src_weekend_empty,
    "src_splits_json": src_splits_json,
    "src_splits_range": src_splits_range,
    "src_splits_empty": src_splits_empty,
    "src_ticker_details": src_ticker_details,
    "src_quotes": src_quotes,
    "scan_partition": scan_partition,
    "scan_projection": scan_projection,
    "sink_dynamic_overwrite": sink_dynamic_overwrite,
    "publish_partition": publish_partition_twice,
    "wap_publish": wap_publish,
    "merge_matched_update": merge_matched_update,
    "filter_valid_bars": filter_valid_bars,
    "filter_quotes": filter_quotes,
    "filter_symbols": filter_symbols,
    "market_cap_bucket": market_cap_buckets,
    "epoch_to_date": epoch_to_date,
    "prev_weekday": prev_weekday,
    "parse_quote_ts": parse_quote_ts,
    "split_rank": split_rank,
    "split_factors": split_factors,
    "split_asof_map": split_asof_map,
    "adjusted_bars": adjusted_bars,
    "attach_max_date": attach_max_date,
    "price_array_agg": price_array_agg,
    "today_arrays": today_arrays,
    "unnest_prices": unnest_prices,
    "trim_year": trim_year,
    "yesterday_split_adjust": yesterday_split_adjust,
    "yesterday_no_split": yesterday_no_split,
    "cumulative_backfill": cumulative_backfill,
    "cumulative_daily": cumulative_daily,
    "late_split_fix": late_split_fix,
    "dim_daily_prices": dim_daily_prices,
    "dim_daily_prices_weekend": dim_daily_prices_weekend,
    "dim_daily_prices_latest": dim_daily_prices_latest,
    "ticker_details": ticker_detail_table,
    "latest_details": latest_detail_rows,
    "current_day_init": current_day_init,
    "latest_quote": latest_quote_rows,
    "quote_metrics": quote_metric_rows,
    "apply_quotes": quotes_applied,
    **{name: _board(name) for name in BOARDS},
    "top50_by_cap": top50_by_cap,
    "top50_cross_filter": top50_cross_filter,
    "change_by_cap": changes_by_cap,
    "dataset_count": dataset_count,
    "dq_bars_not_null": dq_bars_not_null,
    "dq_splits": dq_splits,
    "dq_growth": dq_growth,
    "dq_growth_first_day": dq_growth_first_day,
    "dq_report": dq_report,
    "dq_empty_passes": dq_empty_passes,
    "catchup_three_days": _catch_up(buckets=None),
    "catchup_three_days_bucketed": _catch_up(buckets=8),
    "catchup_late_split": catchup_late_split,
    "catchup_relanded_split": catchup_relanded_split,
    "catchup_withdrawn_split": catchup_withdrawn_split,
    "split_ledger": split_ledger,
    "src_split_documents": src_split_documents,
    "publish_snapshot": publish_snapshot,
    "backfill_from_files": backfill_from_files,
    "attach_staged_max_date": attach_staged_max_date,
    "stream_current_day": stream_current_day,
    "stream_last_write_wins": stream_last_write_wins,
    "src_daily_among_days": src_daily_among_days,
    "dq_bars_broken": dq_bars_broken,
    "dq_splits_broken": dq_splits_broken,
    "top5_above_365d": _top5(False),
    "top5_below_365d": _top5(True),
    "board_updated_between": board_updated_between,
    "create_table_once": create_table_once,
    "replace_whole_table": replace_whole_table,
    "latest_details_partitioned": latest_details_partitioned,
}
