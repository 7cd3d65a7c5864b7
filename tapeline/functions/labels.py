"""Keys and category labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for NULL in a surrogate key, market-cap buckets and
# interest-rate regimes (lower bound, label), highest first.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
CAP_BUCKETS = [
    (1_000_000_000_000, "Mega Cap (>$1T)"),
    (200_000_000_000, "Large Cap ($200B–$1T)"),
    (10_000_000_000, "Mid Cap ($10B–$200B)"),
    (2_000_000_000, "Small Cap ($2B–$10B)"),
]
CAP_SMALLEST = "Micro Cap (<$2B)"
CAP_UNKNOWN = "Unknown"
RATE_REGIMES = [
    (5.0, "High Rates (≥5%)"),
    (3.0, "Elevated Rates (3–5%)"),
    (1.0, "Normal Rates (1–3%)"),
]
RATE_LOWEST = "Low Rates (<1%)"


def surrogate_key(*cols: Column) -> Column:
    """md5 over the natural key, so that equal keys hash alike on every run."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def banded(value: Column, bands: list[tuple[float, str]], below: str) -> Column:
    """Label of the first band whose lower bound the value reaches."""
    label = F.lit(below)
    for bound, name in reversed(bands):
        label = F.when(value >= bound, name).otherwise(label)
    return label


def market_cap_category(market_cap: Column) -> Column:
    return F.when(market_cap.isNull(), CAP_UNKNOWN).otherwise(
        banded(market_cap, CAP_BUCKETS, CAP_SMALLEST)
    )


def rate_regime(fed_funds_rate: Column) -> Column:
    return banded(fed_funds_rate, RATE_REGIMES, RATE_LOWEST)


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)
