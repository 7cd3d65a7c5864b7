"""Macro series aligned with trading days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.numbers import rnd

# Series and the column each one fills.
SERIES = {
    "FEDFUNDS": "fed_funds_rate",
    "CPIAUCSL": "cpi",
    "UNRATE": "unemployment_rate",
    "DGS10": "treasury_yield_10y",
    "A191RL1Q225SBEA": "gdp_growth_rate",
    "T10YIE": "breakeven_inflation_10y",
}
MACRO_COLUMNS = [*SERIES.values(), "real_yield_10y"]


def trading_dates(stg_prices: DataFrame) -> DataFrame:
    """Days on which any ticker traded: at most 366 a year."""
    return stg_prices.select("trading_date").distinct()


def pivot_indicators(observations: DataFrame) -> DataFrame:
    """One row per observation date, one column per series."""
    return _widen(observations, "observation_date", "value")


def int_macro_context(stg_prices: DataFrame, observations: DataFrame) -> DataFrame:
    """Per trading date the last observation of each series on a trading date.

    An observation dated on a day without trading is lost, as it matches no
    date of the spine; ``asof_macro_context`` keeps it.
    """
    on_a_day = F.expr(f"lead(calendar_date) OVER ({_SERIES}) = calendar_date")
    merged = _merged(stg_prices, observations)
    return _filled(merged.withColumn("value", F.when(on_a_day, F.col("value"))))


def asof_macro_context(stg_prices: DataFrame, observations: DataFrame) -> DataFrame:
    """Per trading date the last observation of each series at or before it."""
    return _filled(_merged(stg_prices, observations))


# On the same date the observation (is_day false) comes before the trading day.
_SERIES = "PARTITION BY series_id ORDER BY calendar_date, is_day"


def _merged(stg_prices: DataFrame, observations: DataFrame) -> DataFrame:
    """Observations and trading days of each series in one frame.

    Observations collapse to one per series and day first, so a series has at
    most two rows per calendar day, however often an observation was repeated.
    """
    known = (
        observations.filter(F.col("series_id").isin(*SERIES))
        .groupBy("series_id", F.col("observation_date").alias("calendar_date"))
        .agg(F.max("value").alias("value"))
        .withColumn("is_day", F.lit(False))
    )
    every_series = F.explode(F.array(*[F.lit(s) for s in SERIES]))
    wanted = trading_dates(stg_prices).select(
        every_series.alias("series_id"),
        F.col("trading_date").alias("calendar_date"),
        F.lit(None).cast("double").alias("value"),
        F.lit(True).alias("is_day"),
    )
    return known.union(wanted)


def _filled(merged: DataFrame) -> DataFrame:
    """Carry the last value of each series forward to the trading days."""
    upto = f"{_SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    last = F.expr(f"last_value(value) IGNORE NULLS OVER ({upto})")
    filled = merged.withColumn("value", last).filter("is_day")
    gap = F.col("treasury_yield_10y") - F.col("breakeven_inflation_10y")
    return _widen(filled, "calendar_date", "value").withColumn(
        "real_yield_10y", rnd(gap, 4)
    )


def _widen(long: DataFrame, date: str, value: str) -> DataFrame:
    """Conditional maxima: one aggregation, where ``pivot`` would take two."""
    return long.groupBy(date).agg(
        *[
            F.expr(f"max(CASE WHEN series_id = '{series}' THEN {value} END) AS {column}")
            for series, column in SERIES.items()
        ]
    )
