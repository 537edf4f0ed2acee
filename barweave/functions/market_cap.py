"""Market-capitalisation categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_PROVIDED = "Not Provided"

# Exclusive lower bound in dollars -> category, largest first.
CAP_BOUNDS = [
    (200_000_000_000, "Mega Cap"),
    (10_000_000_000, "Large Cap"),
    (2_000_000_000, "Mid Cap"),
    (250_000_000, "Small Cap"),
]
SMALLEST = "Micro Cap"


def market_cap_bucket(market_cap: Column) -> Column:
    # NaN compares greater than every number, so it has to be caught first.
    bucket = F.when(market_cap.isNull() | F.isnan(market_cap), NOT_PROVIDED)
    for bound, name in CAP_BOUNDS:
        bucket = bucket.when(market_cap > bound, name)
    return bucket.otherwise(SMALLEST)
