"""Long-run figures per ticker: growth, risk-adjusted return, drawdown."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.finance import TRADING_DAYS, cagr, drawdown, fall_from_peak, sharpe
from tapeline.functions.numbers import exact_avg, rnd, steady_avg, steady_stddev


def cagr_by_ticker(stg: DataFrame) -> DataFrame:
    """Annual growth from first to last close; a year is 365.25 days."""
    start = F.min_by("close_price", "trading_date")
    end = F.max_by("close_price", "trading_date")
    span = F.datediff(F.max("trading_date"), F.min("trading_date"))
    years = span / F.lit(365.25)
    return stg.groupBy("ticker").agg(
        start.alias("start_price"),
        end.alias("end_price"),
        rnd(years, 4).alias("years"),
        rnd(cagr(start, end, years), 6).alias("cagr"),
    )


def sharpe_by_ticker(fact: DataFrame) -> DataFrame:
    """Annualised mean log return over the mean ten-year yield, per unit of
    annualised volatility; all in percent."""
    log = F.col("log_return_pct")
    mean = exact_avg(log) * TRADING_DAYS
    free = steady_avg(F.col("treasury_yield_10y"))
    risk = steady_stddev(log) * F.lit(math.sqrt(TRADING_DAYS))
    return fact.groupBy("ticker").agg(
        rnd(mean, 4).alias("annual_return_pct"),
        rnd(free, 4).alias("risk_free_pct"),
        rnd(risk, 4).alias("annual_volatility_pct"),
        rnd(sharpe(mean, free, risk), 4).alias("sharpe_ratio"),
    )


def drawdown_series(stg: DataFrame, cut: bool = False) -> DataFrame:
    """Distance below the running peak per row.

    With ``cut``, for series of unknown length, the peak is found in two steps:
    within each calendar year, and over the peaks of the years before.
    """
    rows = stg.select("ticker", "trading_date", "close_price")
    if not cut:
        fall = drawdown(F.col("close_price"), F.col("ticker"), F.col("trading_date"))
        return rows.withColumn("drawdown", fall)

    year = F.year("trading_date")
    so_far = _upto(Window.partitionBy("ticker", "year").orderBy("trading_date"), 0)
    earlier = _upto(Window.partitionBy("ticker").orderBy("year"), -1)
    peaks = (
        rows.groupBy("ticker", year.alias("year"))
        .agg(F.max("close_price").alias("year_peak"))
        .select("ticker", "year", F.max("year_peak").over(earlier).alias("old_peak"))
    )
    # The join on ticker and year reuses the partitioning of the window.
    return (
        rows.withColumn("year", year)
        .withColumn("new_peak", F.max("close_price").over(so_far))
        .join(peaks, ["ticker", "year"])
        .select(
            "ticker", "trading_date", "close_price",
            fall_from_peak(
                F.col("close_price"), F.greatest("new_peak", "old_peak")
            ).alias("drawdown"),
        )
    )


def _upto(window, last: int):
    return window.rowsBetween(Window.unboundedPreceding, last)


def max_drawdown_by_ticker(series: DataFrame) -> DataFrame:
    return series.groupBy("ticker").agg(F.min("drawdown").alias("max_drawdown"))
