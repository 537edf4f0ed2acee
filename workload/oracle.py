"""The registered queries as SQL over the given tables, for DuckDB.

Written independently of the DataFrame code: reduced lists of ratios, ASOF joins and flat rows
where the package uses folds and arrays.
"""

from __future__ import annotations

from datetime import date, timedelta

from .views import DAY, SUNDAY

EVE = DAY - timedelta(days=1)
LATE_FROM = date(2000, 1, 1)


def _round(expression: str, digits: int) -> str:
    """Round half up on the printed decimal value, as Spark rounds doubles. DuckDB's own
    round() of a double works on the binary value and differs on ties."""
    exact = f"CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,14))"
    return f"CAST(CAST(round({exact}, {digits}) AS VARCHAR) AS DOUBLE)"


def _adjusted(split_from: str, split_to: str, prefix: str = "") -> str:
    columns = [_round(f"{prefix}volume * {split_to} / {split_from}", 4) + " AS volume"]
    for name in ("open", "close", "high", "low"):
        columns.append(_round(f"{prefix}{name} * {split_from} / {split_to}", 4) + f" AS {name}")
    return ", ".join(columns)


# ---- input views ----------------------------------------------------------------------------

BARS = """
bars AS (
  SELECT 'S' || l_suppkey AS ticker,
    CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume,
    min_by(l_extendedprice, (l_orderkey*10 + l_linenumber)*1000000 + l_partkey) AS open,
    max_by(l_extendedprice, (l_orderkey*10 + l_linenumber)*1000000 + l_partkey) AS close,
    MAX(l_extendedprice) AS high, MIN(l_extendedprice) AS low,
    CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400000000000
      + 14400000000000 AS window_start,
    COUNT(*) AS transactions, CAST(l_shipdate AS DATE) AS snapshot_date
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE))"""

SPLITS = f"""
splits AS (
  SELECT CAST(DATE '1996-01-01' + CAST((s_suppkey*211 + i*577) % 1800 AS INT) AS VARCHAR) AS execution_date,
    CAST(1 + (s_suppkey + i) % 2 AS DOUBLE) AS split_from,
    CAST(1 + (s_suppkey*7 + i*3) % 10 AS DOUBLE) AS split_to,
    'S' || s_suppkey AS ticker, DATE '{DAY}' AS as_of_date
  FROM (SELECT s_suppkey, unnest([1, 2]) AS i FROM supplier))"""

DAY_SPLITS = f"""
day_splits AS (
  SELECT '{DAY}' AS execution_date,
    CASE WHEN s_acctbal < 0 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS split_from,
    CASE WHEN s_acctbal < 0 THEN 1.0::DOUBLE ELSE 10.0::DOUBLE END AS split_to,
    'S' || s_suppkey AS ticker, DATE '{DAY}' AS as_of_date
  FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 5000)"""

MARKET_CAP = """CASE WHEN s_suppkey % 11 = 0 THEN CAST(NULL AS DOUBLE)
    WHEN s_suppkey % 13 = 0 THEN CAST('NaN' AS DOUBLE)
    WHEN s_suppkey % 4 = 0 THEN s_acctbal*100000 ELSE s_acctbal*30000000 END"""

BUCKET = """CASE WHEN market_cap IS NULL OR isnan(market_cap) THEN 'Not Provided'
    WHEN market_cap > 200e9 THEN 'Mega Cap' WHEN market_cap > 10e9 THEN 'Large Cap'
    WHEN market_cap > 2e9 THEN 'Mid Cap' WHEN market_cap > 250e6 THEN 'Small Cap'
    ELSE 'Micro Cap' END AS market_cap_description"""

DETAILS = f"""
details AS (
  SELECT *, {BUCKET} FROM (
    SELECT 'S' || s_suppkey AS ticker, s_name AS company_name, {MARKET_CAP} AS market_cap,
      unnest([DATE '2000-06-01', DATE '2000-06-10']) AS as_of_date
    FROM supplier))"""

QUOTES = """
quotes AS (
  SELECT 'S' || user_id AS ticker,
    CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE)
      ELSE CAST(CAST(value AS DECIMAL(12,2))*100 AS DOUBLE) END AS c,
    ts AS t, event_id
  FROM events)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


# ---- splits ---------------------------------------------------------------------------------


def _factors(name: str, source: str) -> str:
    """Each split's running product, from the ticker's list of splits, newest first."""

    def product(field: str) -> str:
        step = _round("x * y", 4)
        return f"list_reduce([s.{field} FOR s IN known[:rn]], lambda x, y: {step})"

    return f"""
{name}_lists AS (
  SELECT ticker, list({{'executed': CAST(execution_date AS DATE), 'split_from': split_from,
    'split_to': split_to, 'as_of_date': as_of_date}} ORDER BY execution_date DESC) AS known
  FROM {source} GROUP BY ticker),
{name} AS (
  SELECT ticker, known[rn].executed AS executed, {product("split_from")} AS split_from,
    {product("split_to")} AS split_to, known[rn].as_of_date AS as_of_date, rn
  FROM (SELECT *, unnest(range(1, len(known) + 1)) AS rn FROM {name}_lists))"""


def _history(name: str, as_of: str, until: date | None) -> str:
    """CTEs for the adjusted bars of one year, flat. ``until`` = newest split known."""
    known = f"(SELECT * FROM splits WHERE execution_date <= '{until}')" if until else "splits"
    ratio = ("coalesce(f.split_from, 1)", "coalesce(f.split_to, 1)")
    return (
        _factors(f"{name}_f", known)
        + f""",
{name}_date AS (SELECT {as_of} AS d),
{name}_tickers AS (
  SELECT DISTINCT ticker FROM bars, {name}_date WHERE snapshot_date <= d),
{name} AS (
  SELECT b.ticker, {_adjusted(*ratio, prefix="b.")}, b.transactions, b.snapshot_date
  FROM (SELECT bars.* FROM bars, {name}_date
        WHERE snapshot_date <= d AND snapshot_date > d - 365) b
  ASOF LEFT JOIN {name}_f f ON b.ticker = f.ticker AND b.snapshot_date < f.executed)"""
    )


MAX_DATE = "(SELECT MAX(snapshot_date) FROM bars)"
EVE_HISTORY = _history("eve", f"DATE '{EVE}'", EVE)


def _step(name: str, before: str, splits: str, day: date) -> str:
    """CTE for the arrays after ``day``, flat, from those of the day before."""
    weekday = day.weekday() < 5
    today = f"""
  UNION ALL
  SELECT ticker, CAST(volume AS DOUBLE), open, close, high, low, transactions, snapshot_date
  FROM bars WHERE snapshot_date = DATE '{day}' AND volume > 0 AND open > 0 AND close > 0
    AND high > 0 AND low > 0 AND transactions > 0"""
    restated = f"""CASE WHEN s.ticker IS NULL THEN %(name)s ELSE %(adjusted)s END AS %(name)s"""
    columns = [
        restated
        % {"name": f"b.{name}", "adjusted": _round(f"b.{name} * {up} / {down}", 4)}
        for name, up, down in [
            ("volume", "s.split_to", "s.split_from"),
            *[(n, "s.split_from", "s.split_to") for n in ("open", "close", "high", "low")],
        ]
    ]
    columns = [column.replace("END AS b.", "END AS ") for column in columns]
    return f"""
{name} AS (
  SELECT b.ticker, {", ".join(columns)}, b.transactions, b.snapshot_date
  FROM {before} b LEFT JOIN (
    SELECT ticker, product(split_from) AS split_from, product(split_to) AS split_to
    FROM {splits} WHERE execution_date = '{day}' GROUP BY ticker) s ON b.ticker = s.ticker
  WHERE b.snapshot_date > DATE '{day}' - 365{today if weekday else ""})"""


DAY_STEP = _step("today", "eve", "day_splits", DAY)


def _flat(source: str, as_of: str, tickers: str | None = None) -> str:
    """Positions newest first; tickers without a bar keep one row when ``tickers`` is given."""
    position = (
        "CAST(row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) AS INTEGER)"
    )
    columns = "volume, open, close, high, low, transactions, snapshot_date"
    rows = f"SELECT ticker, {position} AS position, {columns} FROM {source}"
    if tickers is None:
        return f"SELECT ticker, {as_of} AS as_of_date, position, {columns} FROM ({rows})"
    return f"""SELECT k.ticker, {as_of} AS as_of_date, position, {columns}
FROM {tickers} k LEFT JOIN ({rows}) r ON k.ticker = r.ticker"""


# ---- reference prices -----------------------------------------------------------------------


def _mean(condition: str) -> str:
    """Sum in array order, newest first, then divide."""
    closes = f"list(close ORDER BY snapshot_date DESC) FILTER (WHERE {condition})"
    return f"list_reduce({closes}, lambda s, x: s + x) / count(*) FILTER (WHERE {condition})"


def _prices(name: str, source: str, day: date, tickers: str, last: str | None = None) -> str:
    weekday = day - timedelta(days=max(day.weekday() - 4, 0))
    last = last or f"max(close) FILTER (WHERE snapshot_date = DATE '{weekday}')"
    return f"""
{name} AS (
  SELECT k.ticker, close_price_last_day, close_price_avg_last_90_days,
    close_price_avg_last_365_days, DATE '{day}' AS as_of_date
  FROM {tickers} k LEFT JOIN (
    SELECT ticker, {last} AS close_price_last_day,
      {_mean(f"snapshot_date > DATE '{day}' - 90")} AS close_price_avg_last_90_days,
      {_mean("true")} AS close_price_avg_last_365_days
    FROM {source} GROUP BY ticker) p ON k.ticker = p.ticker)"""


DAY_TICKERS = """
today_tickers AS (
  SELECT ticker FROM eve_tickers UNION SELECT ticker FROM today)"""

TO_PRICES = [
    BARS, SPLITS, DAY_SPLITS, EVE_HISTORY, DAY_STEP, DAY_TICKERS,
    _prices("prices", "today", DAY, "today_tickers"),
]

BASES = {
    "last_day": "close_price_last_day",
    "last_90_days": "close_price_avg_last_90_days",
    "last_365_days": "close_price_avg_last_365_days",
}
METRICS = [f"m_price_change_{n}{suffix}" for n in BASES for suffix in ("", "_pct")]

CURRENT = """
current_rows AS (
  SELECT p.ticker, close_price_last_day, close_price_avg_last_90_days,
    close_price_avg_last_365_days, CAST(NULL AS DOUBLE) AS current_price, """ + ", ".join(
    f"CAST(NULL AS DOUBLE) AS {name}" for name in METRICS
) + """,
    coalesce(d.market_cap_description, 'Not Provided') AS market_cap_description,
    CAST(NULL AS TIMESTAMP) AS last_updated_datetime
  FROM prices p LEFT JOIN (
    SELECT * FROM details WHERE as_of_date = (SELECT max(as_of_date) FROM details)) d
    ON p.ticker = d.ticker)"""

LATEST = """
latest AS (
  SELECT ticker, arg_max(c, (t, event_id)) AS current_price,
    max(t) AS last_updated_datetime
  FROM quotes WHERE c > 0 GROUP BY ticker)"""

_metric_columns = []
for _name, _base in BASES.items():
    _change = _round(f"l.current_price - {_base}", 2)
    _percent = _round(f"100 * (l.current_price - {_base}) / {_base}", 2)
    _metric_columns.append(f"{_change} AS m_price_change_{_name}")
    _metric_columns.append(
        f"CASE WHEN {_base} IS NOT NULL AND {_base} <> 0 THEN {_percent} END "
        f"AS m_price_change_{_name}_pct"
    )

UPDATES = f"""
updates AS (
  SELECT l.ticker, l.current_price, l.last_updated_datetime, {", ".join(_metric_columns)}
  FROM latest l JOIN prices p ON l.ticker = p.ticker)"""

_kept = ["close_price_last_day", "close_price_avg_last_90_days", "close_price_avg_last_365_days"]
_set = ["current_price", *METRICS, "last_updated_datetime"]
MERGED = f"""
merged AS (
  SELECT c.ticker, {", ".join(f"c.{name}" for name in _kept)}, c.market_cap_description,
    {", ".join(f"CASE WHEN u.ticker IS NULL THEN c.{n} ELSE u.{n} END AS {n}" for n in _set)}
  FROM current_rows c LEFT JOIN updates u ON c.ticker = u.ticker)"""

_arrived = "(event_id % 5, t, c)"
LAST = f"""
latest AS (
  SELECT ticker, arg_max(c, {_arrived}) AS current_price,
    arg_max(t, {_arrived}) AS last_updated_datetime
  FROM quotes WHERE c > 0 GROUP BY ticker)"""

TO_MERGED = [*TO_PRICES, DETAILS, QUOTES, CURRENT, LATEST, UPDATES, MERGED]


def _board(metric: str, direction: str, where: str = "true", n: int = 50) -> str:
    return f"""SELECT ticker, max({metric}) AS {metric} FROM merged
WHERE {metric} IS NOT NULL AND {where}
GROUP BY ticker ORDER BY max({metric}) {direction}, ticker LIMIT {n}"""


# ---- data quality ---------------------------------------------------------------------------

_BAR_COLUMNS = "ticker volume open close high low transactions snapshot_date".split()
_SPLIT_COLUMNS = "execution_date split_from split_to ticker".split()


def _not_null(columns: list[str]) -> list[tuple[str, str]]:
    return [
        (f"{name}_is_not_null_check", f"count(*) FILTER (WHERE {name} IS NULL) = 0")
        for name in columns
    ]


SPLIT_CHECKS = _not_null(_SPLIT_COLUMNS) + [
    (f"{name}_is_positive_check", f"count(*) FILTER (WHERE {name} <= 0) = 0")
    for name in ("split_from", "split_to")
]


def _check(checks: list[tuple[str, str]], source: str) -> str:
    return "SELECT " + ", ".join(f"{test} AS {name}" for name, test in checks) + f" FROM {source}"


def _report(checks: list[tuple[str, str]], table: str, source: str) -> list[str]:
    return [
        f"SELECT '{name}' AS check_name, {test} AS passed, '{table}' AS table_name FROM {source}"
        for name, test in checks
    ]


DQ_REPORT = "\nUNION ALL ".join(
    _report(_not_null(_BAR_COLUMNS), "bars", "bars")
    + _report(
        [("bars_are_unique_check", "count(*) FILTER (WHERE n > 1) = 0")],
        "bars",
        "(SELECT count(*) AS n FROM bars GROUP BY ticker, snapshot_date)",
    )
    + _report(
        [
            (
                "snapshot_date_is_day_check",
                f"count(*) FILTER (WHERE snapshot_date <> DATE '{DAY}') = 0",
            )
        ],
        "bars",
        "bars",
    )
    + _report(SPLIT_CHECKS, "splits", "splits")
)

# ---- files ----------------------------------------------------------------------------------

FEED = """
feed AS (SELECT * FROM splits UNION ALL SELECT * FROM day_splits)"""


def _feed(condition: str) -> str:
    return f"""SELECT execution_date, split_from, split_to, ticker, DATE '{DAY}' AS as_of_date
FROM feed WHERE {condition}"""


DOCUMENTS = f"""
documents_found AS (
  SELECT 'S' || s_suppkey AS ticker, 'S' AS ticker_root, s_name AS name,
    s_acctbal > 1000 AS active, 'usd' AS currency_name, 'us' AS locale,
    CASE WHEN s_nationkey < 20 THEN 'stocks' ELSE 'otc' END AS market,
    {MARKET_CAP} AS market_cap, 'X' || s_nationkey AS primary_exchange,
    'RETAIL' AS sic_description, CAST(s_suppkey AS DOUBLE) AS weighted_shares_outstanding
  FROM supplier WHERE s_acctbal >= 0)"""

_days = [DAY + timedelta(days=offset) for offset in range(3)]
CATCH_UP = _with(
    BARS, SPLITS, DAY_SPLITS, FEED, EVE_HISTORY,
    _step("day0", "eve", "feed", _days[0]),
    _step("day1", "day0", "feed", _days[1]),
    _step("day2", "day1", "feed", _days[2]),
    *[
        f"""
day{i}_tickers AS (SELECT ticker FROM {"eve" if i == 0 else f"day{i - 1}"}_tickers
  UNION SELECT ticker FROM day{i})"""
        for i in range(3)
    ],
    *[_prices(f"prices{i}", f"day{i}", day, f"day{i}_tickers") for i, day in enumerate(_days)],
    select="SELECT * FROM prices0 UNION ALL SELECT * FROM prices1 UNION ALL SELECT * FROM prices2",
)


def _late(base: str, ratio: str = "split_from, split_to") -> str:
    """CTEs for the bars of ``base`` with the splits of 2000 applied on top, or their inverse."""
    start, end = ratio.split(", ")
    return f"""
late AS (
  SELECT execution_date, ticker, {start} AS split_from, {end} AS split_to FROM splits
  WHERE execution_date > '{LATE_FROM}' AND execution_date <= '{EVE}'),
late_ratio AS (
  SELECT b.ticker, b.snapshot_date, product(l.split_from) AS split_from,
    product(l.split_to) AS split_to
  FROM {base} b JOIN late l ON b.ticker = l.ticker AND b.snapshot_date < CAST(l.execution_date AS DATE)
  GROUP BY b.ticker, b.snapshot_date),
fixed AS (
  SELECT ticker, {_adjusted("coalesce(split_from, 1)", "coalesce(split_to, 1)")}, transactions,
    snapshot_date
  FROM {base} LEFT JOIN late_ratio USING (ticker, snapshot_date))"""


def _parts(checks: list[tuple[str, str]], source: str, part: str) -> str:
    """The checks over all rows (part -1) and over each of four parts."""
    return "\nUNION ALL ".join(
        _check([*checks, ("part", str(number))], f"(SELECT * FROM {source} WHERE {condition})")
        for number, condition in [(-1, "true"), *((n, f"{part} % 4 = {n}") for n in range(4))]
    )


_all_details = "SELECT ticker, company_name, market_cap, as_of_date FROM details"
_bars_broken = """
broken AS (SELECT * REPLACE (
  CASE WHEN transactions % 4 <> 0 THEN close END AS close,
  CASE WHEN transactions % 4 <> 1 THEN volume END AS volume,
  CASE WHEN transactions % 4 <> 1 THEN low END AS low,
  CASE WHEN transactions % 4 <> 2 THEN snapshot_date END AS snapshot_date) FROM bars)"""
_splits_broken = """
numbered AS (SELECT *, CAST(substr(ticker, 2) AS INTEGER) AS number FROM splits),
broken AS (SELECT * REPLACE (
  CASE WHEN number % 4 <> 0 THEN split_from END AS split_from,
  CASE WHEN number % 4 = 1 THEN 0 ELSE split_to END AS split_to,
  CASE WHEN number % 4 <> 2 THEN ticker END AS ticker) FROM numbered)"""
_middle = """last_updated_datetime BETWEEN
  (SELECT make_timestamp((epoch_us(min(t)) + 31 * epoch_us(max(t))) // 32) FROM quotes)
  AND (SELECT make_timestamp((epoch_us(min(t)) + 255 * epoch_us(max(t))) // 256) FROM quotes)"""
_all_tickers = """
all_tickers AS (SELECT ticker FROM eve_tickers UNION SELECT ticker FROM day0
  UNION SELECT ticker FROM day1)"""
_late_start = _history("eve", f"DATE '{EVE}'", LATE_FROM)
_merged = _with(*TO_MERGED, select="SELECT * FROM merged")
_ratio = ("coalesce(f.split_from, 1)", "coalesce(f.split_to, 1)")
_all_adjusted = f"""
adjusted AS (
  SELECT b.ticker, {_adjusted(*_ratio, prefix="b.")}, b.transactions, b.snapshot_date
  FROM bars b ASOF LEFT JOIN factors f ON b.ticker = f.ticker AND b.snapshot_date < f.executed)"""
_all_factors = _factors("factors", "splits")
_eve_flat = [BARS, SPLITS, DAY_SPLITS, EVE_HISTORY]
_today_flat = _flat("today", f"DATE '{DAY}'", "today_tickers")

ORACLE: dict[str, str] = {
    "src_daily_csv": _with(
        BARS, select=f"SELECT * FROM bars WHERE snapshot_date = DATE '{DAY}'"
    ),
    "src_backfill_csv": _with(BARS, select="SELECT * FROM bars"),
    "src_weekend_empty": _with(
        BARS,
        select=f"""SELECT * FROM bars WHERE isodow(snapshot_date) < 6
AND snapshot_date BETWEEN DATE '{DAY + timedelta(days=1)}' AND DATE '{DAY + timedelta(days=4)}'""",
    ),
    "src_splits_json": _with(
        SPLITS, DAY_SPLITS, FEED, select=_feed(f"execution_date = '{DAY}'")
    ),
    "src_splits_range": _with(
        SPLITS, DAY_SPLITS, FEED, select=_feed(f"execution_date BETWEEN '1997-01-01' AND '{DAY}'")
    ),
    "src_splits_empty": _with(
        SPLITS, DAY_SPLITS, FEED, select=_feed("execution_date = '1995-06-01'")
    ),
    "src_ticker_details": _with(DOCUMENTS, select="SELECT * FROM documents_found"),
    "src_quotes": _with(
        QUOTES, select="SELECT ticker, c, strftime(t, '%Y-%m-%dT%H:%M:%S.%fZ') AS t FROM quotes"
    ),
    "scan_partition": _with(
        DETAILS, select="SELECT * FROM details WHERE as_of_date = DATE '2000-06-10'"
    ),
    "scan_projection": _with(*TO_MERGED, select=f"SELECT ticker, {', '.join(_kept)} FROM merged"),
    "sink_dynamic_overwrite": _with(
        BARS, SPLITS, _all_factors, _all_adjusted,
        select="""SELECT *, CAST(year(snapshot_date) AS INTEGER) AS year FROM adjusted
WHERE year(snapshot_date) = 2000
UNION ALL
SELECT ticker, CAST(volume AS DOUBLE), open, close, high, low, transactions, snapshot_date,
  CAST(year(snapshot_date) AS INTEGER)
FROM bars WHERE year(snapshot_date) <> 2000""",
    ),
    "publish_partition": _with(*TO_PRICES, select="SELECT * FROM prices"),
    "wap_publish": _with(
        *_eve_flat, DAY_STEP, DAY_TICKERS,
        select=_today_flat + "\nUNION ALL\n" + _flat("eve", f"DATE '{EVE}'", "eve_tickers"),
    ),
    "merge_matched_update": _merged,
    "filter_valid_bars": _with(
        BARS,
        select="""SELECT * REPLACE (close - low AS low) FROM bars
WHERE volume > 0 AND open > 0 AND close > 0 AND high > 0 AND close - low > 0 AND transactions > 0""",
    ),
    "filter_quotes": _with(QUOTES, select="SELECT ticker, c, event_id FROM quotes WHERE c > 0"),
    "filter_symbols": """SELECT symbol, 'active' AS status FROM (
  SELECT 'S' || s_suppkey AS symbol FROM supplier
  UNION ALL SELECT 'C' || c_custkey || '/USD' FROM customer)
WHERE symbol NOT LIKE '%/%'""",
    "market_cap_bucket": _with(
        DETAILS, select="SELECT ticker, as_of_date, market_cap_description FROM details"
    ),
    "epoch_to_date": _with(BARS, select="SELECT ticker, window_start, snapshot_date FROM bars"),
    "prev_weekday": """SELECT o_orderkey, CAST(CASE isodow(o_orderdate)
  WHEN 7 THEN CAST(o_orderdate AS DATE) - 2 WHEN 6 THEN CAST(o_orderdate AS DATE) - 1
  ELSE CAST(o_orderdate AS DATE) END AS DATE) AS prev_weekday FROM orders""",
    "parse_quote_ts": _with(
        QUOTES,
        select="""SELECT event_id, t, CAST(date_trunc('second', t) AS TIMESTAMP) AS t_seconds,
  CAST(NULL AS TIMESTAMP) AS t_none FROM quotes""",
    ),
    "split_rank": _with(
        SPLITS,
        select="""SELECT ticker, CAST(execution_date AS DATE) AS execution_date, split_from,
  split_to, as_of_date,
  row_number() OVER (PARTITION BY ticker ORDER BY execution_date DESC) AS row_number FROM splits""",
    ),
    "split_factors": _with(
        SPLITS, _all_factors,
        select="""SELECT ticker, executed AS execution_date, split_from, split_to, as_of_date,
  rn AS row_number FROM factors""",
    ),
    "split_asof_map": _with(
        BARS, SPLITS, _all_factors,
        select="""SELECT b.ticker, b.snapshot_date, f.split_from, f.split_to
FROM bars b ASOF LEFT JOIN factors f ON b.ticker = f.ticker AND b.snapshot_date < f.executed""",
    ),
    "adjusted_bars": _with(
        BARS, SPLITS, _all_factors, _all_adjusted, select="SELECT * FROM adjusted"
    ),
    "attach_max_date": _with(
        BARS,
        select=f"""SELECT ticker, snapshot_date, close, {MAX_DATE} AS as_of_date FROM bars""",
    ),
    "price_array_agg": _with(
        BARS,
        select=_flat(
            "(SELECT * REPLACE (CAST(volume AS DOUBLE) AS volume) FROM bars)", MAX_DATE
        ),
    ),
    "today_arrays": _with(
        BARS,
        select="""SELECT ticker, snapshot_date AS as_of_date, 1 AS position,
  CAST(volume AS DOUBLE) AS volume, open, close, high, low, transactions, snapshot_date
FROM bars WHERE volume > 0 AND open > 0 AND close > 0 AND high > 0 AND low > 0
  AND transactions > 0""",
    ),
    "unnest_prices": _with(
        BARS, SPLITS, EVE_HISTORY,
        select=f"""SELECT ticker, DATE '{EVE}' AS as_of_date, volume, open, close, high, low,
  transactions, snapshot_date FROM eve""",
    ),
    "trim_year": _with(
        BARS,
        f"""
until AS (SELECT * REPLACE (CAST(volume AS DOUBLE) AS volume) FROM bars
  WHERE snapshot_date <= DATE '{EVE}' AND snapshot_date > DATE '{EVE}' - 364),
until_tickers AS (SELECT DISTINCT ticker FROM bars WHERE snapshot_date <= DATE '{EVE}')""",
        select=_flat("until", f"DATE '{EVE}'", "until_tickers"),
    ),
    "yesterday_split_adjust": _with(
        *_eve_flat,
        f"""
restated AS (
  SELECT b.ticker, {_adjusted("s.split_from", "s.split_to", "b.")}, b.transactions,
    b.snapshot_date
  FROM eve b JOIN day_splits s ON b.ticker = s.ticker
  WHERE b.snapshot_date > DATE '{EVE}' - 364),
restated_tickers AS (
  SELECT k.ticker FROM eve_tickers k JOIN day_splits s ON k.ticker = s.ticker)""",
        select=_flat("restated", f"DATE '{EVE}'", "restated_tickers"),
    ),
    "yesterday_no_split": _with(
        *_eve_flat,
        f"""
kept AS (
  SELECT b.* FROM eve b LEFT JOIN day_splits s ON b.ticker = s.ticker
  WHERE s.execution_date IS NULL AND b.snapshot_date > DATE '{EVE}' - 364),
kept_tickers AS (
  SELECT ticker FROM eve_tickers WHERE ticker NOT IN (SELECT ticker FROM day_splits))""",
        select=_flat("kept", f"DATE '{EVE}'", "kept_tickers"),
    ),
    "cumulative_backfill": _with(
        BARS, SPLITS, _history("whole", MAX_DATE, None),
        select=_flat("whole", MAX_DATE, "whole_tickers"),
    ),
    "cumulative_daily": _with(*_eve_flat, DAY_STEP, DAY_TICKERS, select=_today_flat),
    "late_split_fix": _with(
        BARS, SPLITS, _late_start, _late("eve"),
        select=_flat("fixed", f"DATE '{EVE}'", "eve_tickers"),
    ),
    "dim_daily_prices": _with(*TO_PRICES, select="SELECT * FROM prices"),
    "dim_daily_prices_weekend": _with(
        BARS, SPLITS, _history("sunday", f"DATE '{SUNDAY}'", SUNDAY),
        _prices("prices", "sunday", SUNDAY, "sunday_tickers"),
        select="SELECT * FROM prices",
    ),
    "dim_daily_prices_latest": _with(
        *TO_PRICES[:-1],
        _prices("prices", "today", DAY, "today_tickers", "arg_max(close, snapshot_date)"),
        select="SELECT * FROM prices",
    ),
    "ticker_details": _with(
        DOCUMENTS,
        select=f"""SELECT ticker, ticker_root, name AS company_name, active AS is_actively_traded,
  currency_name, locale AS country, market AS asset_type, market_cap, primary_exchange,
  sic_description AS industry_description, weighted_shares_outstanding, {BUCKET},
  DATE '{DAY}' AS as_of_date FROM documents_found""",
    ),
    "latest_details": _with(
        DETAILS,
        select="""SELECT ticker, as_of_date, market_cap_description FROM details
WHERE as_of_date = (SELECT max(as_of_date) FROM details)""",
    ),
    "current_day_init": _with(*TO_PRICES, DETAILS, CURRENT, select="SELECT * FROM current_rows"),
    "latest_quote": _with(QUOTES, LATEST, select="SELECT * FROM latest"),
    "quote_metrics": _with(*TO_PRICES, QUOTES, LATEST, UPDATES, select="SELECT * FROM updates"),
    "apply_quotes": _merged,
    "top50_above_last_day": _with(*TO_MERGED, select=_board("m_price_change_last_day_pct", "DESC")),
    "top50_below_last_day": _with(*TO_MERGED, select=_board("m_price_change_last_day_pct", "ASC")),
    "top50_below_90d": _with(*TO_MERGED, select=_board("m_price_change_last_90_days_pct", "ASC")),
    "top50_above_90d": _with(*TO_MERGED, select=_board("m_price_change_last_90_days_pct", "DESC")),
    "top50_above_365d": _with(
        *TO_MERGED, select=_board("m_price_change_last_365_days_pct", "DESC")
    ),
    "top50_below_365d": _with(
        *TO_MERGED, select=_board("m_price_change_last_365_days_pct", "ASC")
    ),
    "top50_by_cap": _with(
        *TO_MERGED,
        select=_board(
            "m_price_change_last_365_days_pct",
            "DESC",
            "market_cap_description IN ('Mega Cap', 'Large Cap', 'Not Provided')",
        ),
    ),
    "top50_cross_filter": _with(
        *TO_MERGED,
        f"\nselected AS ({_board('m_price_change_last_365_days_pct', 'DESC')})",
        select=_board(
            "m_price_change_last_90_days_pct", "ASC", "ticker IN (SELECT ticker FROM selected)"
        ),
    ),
    "change_by_cap": _with(
        *TO_MERGED,
        select="SELECT market_cap_description, count(*) AS tickers, "
        + ", ".join(
            f"count({m}) AS {m}_n, CASE WHEN count({m}) > 0 THEN "
            f"CAST(sum(CAST({m} AS DECIMAL(28,2))) AS DOUBLE) / count({m}) END AS {m}_avg, "
            f"min({m}) AS {m}_min, max({m}) AS {m}_max"
            for m in METRICS
        )
        + " FROM merged GROUP BY market_cap_description",
    ),
    "dataset_count": _with(*TO_MERGED, select='SELECT count(*) AS "count" FROM merged'),
    "dq_bars_not_null": _with(BARS, select=_check(_not_null(_BAR_COLUMNS), "bars")),
    "dq_splits": _with(SPLITS, select=_check(SPLIT_CHECKS, "splits")),
    "dq_growth": _with(
        *_eve_flat, DAY_STEP, DAY_TICKERS,
        select="""SELECT (SELECT count(*) FROM today_tickers)
  < (SELECT count(*) FROM eve_tickers) * 1.01 AS new_rows_under_threshold_check""",
    ),
    "dq_growth_first_day": _with(
        BARS,
        select="""SELECT count(*) < count(*) * 1.01 AS new_rows_under_threshold_check
FROM bars WHERE window_start < 0""",
    ),
    "dq_report": _with(BARS, SPLITS, select=DQ_REPORT),
    "dq_empty_passes": _with(
        BARS,
        select=_check(_not_null(_BAR_COLUMNS), "(SELECT * FROM bars WHERE window_start < 0)"),
    ),
    "catchup_three_days": CATCH_UP,
    "catchup_three_days_bucketed": CATCH_UP,
    "catchup_late_split": _with(
        BARS, SPLITS, DAY_SPLITS, FEED, _late_start, _step("day0", "eve", "feed", _days[0]),
        _late("day0"), _step("day1", "fixed", "feed", _days[1]), _all_tickers,
        select=_flat("day1", f"DATE '{_days[1]}'", "all_tickers"),
    ),
    "catchup_relanded_split": _with(
        BARS, SPLITS, DAY_SPLITS, FEED, EVE_HISTORY, _step("day0", "eve", "feed", _days[0]),
        _step("day1", "day0", "feed", _days[1]), _all_tickers,
        select=_flat("day1", f"DATE '{_days[1]}'", "all_tickers"),
    ),
    "catchup_withdrawn_split": _with(
        BARS, SPLITS, DAY_SPLITS, FEED, EVE_HISTORY, _step("day0", "eve", "feed", _days[0]),
        _late("day0", "split_to, split_from"), _step("day1", "fixed", "feed", _days[1]),
        _all_tickers, select=_flat("day1", f"DATE '{_days[1]}'", "all_tickers"),
    ),
    "split_ledger": _with(
        SPLITS,
        select="""SELECT DISTINCT execution_date, ticker,
  CASE WHEN CAST(substr(ticker, 2) AS INTEGER) % 3 = 0 THEN 1 ELSE split_from END AS split_from,
  CASE WHEN CAST(substr(ticker, 2) AS INTEGER) % 3 = 0 THEN 3 ELSE split_to END AS split_to
FROM splits WHERE CAST(substr(ticker, 2) AS INTEGER) % 5 <> 0""",
    ),
    "src_split_documents": _with(
        SPLITS, select="SELECT execution_date, split_from, split_to, ticker, as_of_date FROM splits"
        f" WHERE execution_date <= '{DAY}'",
    ),
    "attach_staged_max_date": _with(
        BARS,
        select=f"""SELECT ticker, snapshot_date, close,
  (SELECT max(snapshot_date) FROM bars WHERE snapshot_date <= DATE '{EVE}') AS as_of_date
FROM bars WHERE snapshot_date BETWEEN DATE '{(EVE - timedelta(days=60)).replace(day=1)}'
  AND DATE '{EVE}'""",
    ),
    "backfill_from_files": _with(
        *_eve_flat,
        select=_flat("eve", f"DATE '{EVE}'", "(SELECT DISTINCT ticker FROM eve)"),
    ),
    "publish_snapshot": _with(
        *TO_PRICES, _prices("eve_prices", "eve", EVE, "eve_tickers"),
        select="""SELECT *, 'first' AS state FROM eve_prices
UNION ALL SELECT *, 'first' FROM prices
UNION ALL SELECT *, 'last' FROM prices WHERE close_price_last_day > 30000""",
    ),
    "src_daily_among_days": _with(
        BARS, select=f"SELECT * FROM bars WHERE snapshot_date = DATE '{EVE}'"
    ),
    "dq_bars_broken": _with(
        BARS, _bars_broken, select=_parts(_not_null(_BAR_COLUMNS), "broken", "transactions")
    ),
    "dq_splits_broken": _with(
        SPLITS, _splits_broken, select=_parts(SPLIT_CHECKS, "broken", "number")
    ),
    "top5_above_365d": _with(
        *TO_MERGED, select=_board("m_price_change_last_365_days_pct", "DESC", n=5)
    ),
    "top5_below_365d": _with(
        *TO_MERGED, select=_board("m_price_change_last_365_days_pct", "ASC", n=5)
    ),
    "board_updated_between": _with(
        *TO_MERGED, select=_board("m_price_change_last_365_days_pct", "DESC", _middle)
    ),
    "create_table_once": _with(DETAILS, select=_all_details),
    "replace_whole_table": _with(
        *TO_PRICES, DETAILS, CURRENT, select="SELECT * FROM current_rows"
    ),
    "latest_details_partitioned": _with(
        DETAILS, select=f"{_all_details} WHERE as_of_date = DATE '2000-06-10'"
    ),
    "stream_current_day": _merged,
    "stream_last_write_wins": _with(
        *TO_PRICES, DETAILS, QUOTES, CURRENT, LAST, UPDATES, MERGED, select="SELECT * FROM merged"
    ),
}
