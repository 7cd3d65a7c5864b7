"""Cleaning of the raw tables.  Narrow maps: no shuffle, filters reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.labels import blank_to_null, surrogate_key
from tapeline.functions.numbers import rnd_sql


def stg_stock_prices(raw: DataFrame) -> DataFrame:
    """Bars with a key, plain names and four-decimal prices.

    Bars without date or close, or without volume, are dropped; a NaN close is
    none, as NaN is how pandas stores a missing price.  The key hashes
    the trading date rather than the raw timestamp, so it does not depend on the
    time zone of the session.
    """
    kept = raw.filter(
        "date IS NOT NULL AND close IS NOT NULL AND NOT isnan(close) AND volume > 0"
    )
    key = surrogate_key(F.col("ticker"), F.col("date").cast("date"))
    change = "try_divide(close - open, open) * 100"
    return kept.select(
        key.alias("price_id"),
        "ticker",
        F.col("date").cast("date").alias("trading_date"),
        *[
            F.expr(f"{rnd_sql(price, 4)} AS {price}_price")
            for price in ("open", "high", "low", "close")
        ],
        "volume",
        F.expr(f"{rnd_sql('high - low', 4)} AS intraday_range"),
        F.expr(f"{rnd_sql(change, 4)} AS intraday_return_pct"),
        "extracted_at",
    )


def stg_company_info(raw: DataFrame, blank_as_null: bool = False) -> DataFrame:
    """Companies with defaults for missing fields.

    An empty string counts as a value unless ``blank_as_null`` is set.
    """

    def filled(name: str, default: str):
        value = blank_to_null(F.col(name)) if blank_as_null else F.col(name)
        return F.coalesce(value, F.lit(default)).alias(name)

    return raw.filter(F.col("ticker").isNotNull()).select(
        "ticker",
        "company_name",
        filled("sector", "Unknown"),
        filled("industry", "Unknown"),
        "market_cap",
        filled("currency", "USD"),
        "exchange",
        filled("country", "Unknown"),
        "website",
        "extracted_at",
    )


def stg_economic_indicators(raw: DataFrame) -> DataFrame:
    """Observations with a date and a number; NaN counts as missing."""
    value = F.col("value").cast("double")
    return raw.filter(
        F.col("observation_date").isNotNull() & value.isNotNull() & ~F.isnan(value)
    ).select(
        "series_id",
        "series_name",
        F.col("observation_date").cast("date").alias("observation_date"),
        value.alias("value"),
        "frequency",
        "extracted_at",
    )


def enrich_from_seed(companies: DataFrame, seed: DataFrame) -> DataFrame:
    """Fill sector and industry from the reference list where they are missing
    or unknown.  Both sides are one row per ticker; Spark broadcasts the list
    when its size allows and shuffles on the ticker otherwise."""

    def better(name: str):
        own = blank_to_null(F.col(f"c.{name}"))
        known = F.when(own != "Unknown", own)
        return F.coalesce(known, F.col(f"s.{name}"), F.lit("Unknown")).alias(name)

    return (
        companies.alias("c")
        .join(seed.alias("s"), F.col("c.ticker") == F.col("s.ticker"), "left")
        .select(
            "c.ticker", "c.company_name", better("sector"), better("industry"),
            "c.market_cap", "c.currency", "c.exchange", "c.country",
        )
    )
