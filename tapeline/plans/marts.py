"""Star schema: one fact table and two dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.functions.labels import market_cap_category, surrogate_key
from tapeline.operators.macro import MACRO_COLUMNS, int_macro_context, trading_dates
from tapeline.operators.signals import daily_signals

# Default bounds of the calendar, the end excluded.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2028, 1, 1)

# The columns of the fact.
FACT = [
    "price_id", "ticker", "trading_date",
    "open_price", "close_price", "prev_close_price",
    "daily_return_pct", "log_return_pct", "overnight_gap_pct",
    "sma_7d", "sma_30d", "sma_90d", "sma_200d",
    "volume", "avg_volume_20d", "avg_volume_90d", "relative_volume_20d",
    "high_52w", "low_52w", "price_position_52w",
    "volatility_20d_annualized", "volatility_60d_annualized",
    "avg_intraday_range_pct_20d",
    *MACRO_COLUMNS,
    "company_name", "sector", "industry",
]


def fct_daily_trading(
    stg_prices: DataFrame,
    companies: DataFrame,
    indicators: DataFrame,
    slice_rows: int | None = None,
) -> DataFrame:
    """One row per ticker and trading day."""
    return assemble_fact(
        daily_signals(stg_prices, slice_rows),
        companies,
        int_macro_context(stg_prices, indicators),
    )


def assemble_fact(
    signals: DataFrame, companies: DataFrame, macro: DataFrame
) -> DataFrame:
    return with_macro(with_companies(signals, companies), macro).select(FACT)


def with_companies(signals: DataFrame, companies: DataFrame) -> DataFrame:
    """The signals leave their window hashed and sorted by ticker, so this join
    moves only the companies, however many there are."""
    about = companies.select("ticker", "company_name", "sector", "industry")
    return signals.join(about, "ticker", "left")


def with_macro(signals: DataFrame, macro: DataFrame) -> DataFrame:
    """The macro side has one row per trading date, at most 366 a year however many bars
    there are (25 KB), so it goes to the bars: wide rows of all tickers are not moved
    again by date.  Without the hint Spark guesses its size from that of all trades."""
    context = macro.select(F.col("calendar_date").alias("trading_date"), *MACRO_COLUMNS)
    return signals.join(F.broadcast(context), "trading_date", "left")


def dim_company(companies: DataFrame) -> DataFrame:
    return companies.select(
        surrogate_key(F.col("ticker")).alias("company_key"),
        "ticker", "company_name", "sector", "industry", "market_cap",
        market_cap_category(F.col("market_cap")).alias("market_cap_category"),
        "currency", "exchange", "country", "website", "extracted_at",
    )


def date_spine(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per day from start up to, not including, end."""
    return spark.range((end - start).days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("calendar_date")
    )


def dim_date(
    stg_prices: DataFrame,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    as_of: Column | dt.date | None = None,
) -> DataFrame:
    """Calendar with a trading-day flag.  Flags relative to today use ``as_of``."""
    if as_of is None:
        as_of = F.current_date()
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    day = F.col("calendar_date")
    month_key = F.year(day) * 100 + F.month(day)
    weekday = F.dayofweek(day) - 1
    spine = date_spine(stg_prices.sparkSession, start, end)
    traded = trading_dates(stg_prices)
    return spine.join(traded, day == F.col("trading_date"), "left").select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_of_month"),
        F.quarter(day).alias("quarter_num"),
        weekday.alias("day_of_week"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_name_short"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "EEE").alias("day_name_short"),
        month_key.alias("year_month_key"),
        F.year(day).alias("year_key"),
        F.concat_ws("-Q", F.year(day), F.quarter(day)).alias("fiscal_quarter_label"),
        weekday.isin(0, 6).alias("is_weekend"),
        F.col("trading_date").isNotNull().alias("is_trading_day"),
        (day == today).alias("is_today"),
        (F.year(day) == F.year(today)).alias("is_current_year"),
        (F.trunc(day, "MM") == F.trunc(today, "MM")).alias("is_current_month"),
    )
