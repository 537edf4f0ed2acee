"""Split-adjusted price history and intraday change metrics, as Spark DataFrames."""

from .operators.leaderboard import change_by_cap, leaderboard
from .operators.splits import adjust_bars, cumulative_factors, match_factors, rank_splits
from .operators.details import latest_details, ticker_details
from .operators.merge import merge_matched
from .operators.quotes import latest_quote, quote_metrics
from .plans.daily import (
    Feeds,
    Tables,
    load_details,
    run_day,
    run_days,
    stage_months,
    start_from_files,
    start_history,
)
from .plans.history import apply_late_splits, backfill_cumulative, daily_step
from .plans.intraday import apply_quotes
from .plans.reference_prices import dim_prices, init_current_day

__all__ = [
    "Feeds",
    "Tables",
    "adjust_bars",
    "apply_late_splits",
    "apply_quotes",
    "backfill_cumulative",
    "change_by_cap",
    "cumulative_factors",
    "daily_step",
    "dim_prices",
    "init_current_day",
    "latest_details",
    "latest_quote",
    "leaderboard",
    "load_details",
    "match_factors",
    "merge_matched",
    "quote_metrics",
    "rank_splits",
    "run_day",
    "run_days",
    "stage_months",
    "start_from_files",
    "start_history",
    "ticker_details",
]
