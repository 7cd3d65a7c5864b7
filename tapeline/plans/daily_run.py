"""The full run: raw files in, staging views, mart tables and a quality report out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators import quality
from tapeline.operators.series import SLICE_ROWS
from tapeline.operators.signals import with_signals
from tapeline.operators.staging import (
    stg_company_info,
    stg_economic_indicators,
    stg_stock_prices,
)
from tapeline.plans.marts import (
    CALENDAR_END,
    CALENDAR_START,
    dim_company,
    dim_date,
    fct_daily_trading,
)
from tapeline.sources.readers import read_companies, read_indicators, read_prices
from tapeline.sources.writers import materialize


def build_marts(
    spark: SparkSession,
    raw_dir: str,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    as_of: dt.date | None = None,
    fact_partition: str | None = None,
    fact_buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Build the star schema from raw files and return the mart tables.

    ``fact_partition="trading_date"`` stores the fact by day, so that reports on
    the latest date or year read only those days.  ``fact_buckets`` stores it in so
    many buckets by ticker instead, for reports by ticker without a shuffle.

    The raw files are not known to hold one bar per ticker and day, so series of
    more than SLICE_ROWS bars are cut before the windows.
    """
    prices = read_prices(spark, raw_dir)
    companies = read_companies(spark, raw_dir)
    if prices is None or companies is None:
        raise FileNotFoundError(f"no price or company files in {raw_dir}")
    stg = {
        "stg_stock_prices": stg_stock_prices(prices),
        "stg_company_info": stg_company_info(companies),
        "stg_economic_indicators": stg_economic_indicators(
            read_indicators(spark, raw_dir)
        ),
    }
    for name, df in stg.items():
        materialize(df, name, "staging")
    bars, about, macro = stg.values()
    marts = {
        "fct_daily_trading": fct_daily_trading(bars, about, macro, SLICE_ROWS),
        "dim_company": dim_company(about),
        "dim_date": dim_date(bars, start, end, as_of),
    }
    for name, df in marts.items():
        layout = (fact_partition, fact_buckets) if name == "fct_daily_trading" else ()
        materialize(df, name, "marts", *layout)
    return {name: spark.table(name) for name in marts}


def checks(
    raw: DataFrame,
    stg: DataFrame,
    companies: DataFrame,
    dates: DataFrame,
    min_rows: int = 200,
) -> DataFrame:
    """Quality report over prices, companies and calendar in two passes.

    One pass counts over the raw bars.  The other runs over the staged bars in
    the layout of the signals, by ticker and date: there a repeated key is two
    neighbours, the length of a series is the number of its last row, and the
    companies join without moving a bar.
    """
    raw_rules = {
        "positive_volume": quality.no_volume(),
        **{
            f"raw_{name}": rule
            for name, rule in quality.nulls("open", "high", "low", "close").items()
        },
    }
    known = companies.select("ticker").distinct().withColumn("has_company", F.lit(True))
    calendar = dates.select(
        F.col("calendar_date").alias("trading_date"), F.lit(True).alias("has_date")
    ).distinct()
    staged = (
        quality.with_neighbours(with_signals(stg))
        .join(known, "ticker", "left")
        .join(calendar, "trading_date", "left")
    )
    day, following = F.col("trading_date"), F.col("next_trading_date")
    is_last = following.isNull()
    starts_repeat = (following == day) & ~F.col("prev_trading_date").eqNullSafe(day)
    stg_rules = {
        "valid_ohlc": quality.breaks_ohlc(),
        "reasonable_daily_return": quality.large_return(),
        "reasonable_volatility": quality.odd_volatility(),
        "no_large_date_gaps": quality.large_gap(),
        **quality.nulls("price_id", "ticker", "trading_date", "close_price"),
        "sufficient_history": is_last & (F.col("bar_no") < min_rows),
        "unique_price_id": starts_repeat,
        "tickers_in_dim": is_last & F.col("has_company").isNull(),
    }
    orphans = F.count_distinct(F.when(F.col("has_date").isNull(), day))
    return quality.quality_report(
        [
            quality.count_breaks(raw, quality.count_rules(raw_rules)),
            quality.count_breaks(
                staged,
                quality.count_rules(stg_rules) | {"dates_in_dim": orphans},
            ),
        ]
    )
