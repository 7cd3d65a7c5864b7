"""Result tables over the fact table: per ticker, sector, month and rate regime.

Inputs are the fact table, or any frame with the columns a report reads.  First
and last prices come from ``min_by``/``max_by``, which collapse map-side; no
window and no sort per ticker is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.labels import rate_regime
from tapeline.functions.numbers import exact_avg, ratio, rnd, steady_avg, steady_stddev

#: Decimals of a return that is a fraction: four of the percentage and two.
FRACTION = 1_000_000
from tapeline.operators.macro import MACRO_COLUMNS

#: Percent columns of the macro context; the price index is none.
MACRO_PERCENT = [c for c in MACRO_COLUMNS if c != "cpi"]


def as_fraction(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent columns as fractions."""
    return df.withColumns({c: F.col(c) / 100 for c in columns})


def as_of_date(fact: DataFrame) -> DataFrame:
    return fact.agg(F.max("trading_date").alias("as_of_date"))


def on_latest_date(fact: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Rows of the last trading date of all tickers; a ticker that did not trade
    on it is not in the result.  Give ``dates`` to read that date off a frame
    that is cheaper to compute than the fact."""
    latest = as_of_date(fact if dates is None else dates)
    return fact.filter(F.col("trading_date") == latest.scalar())


def in_trailing_year(fact: DataFrame, days: int = 365) -> DataFrame:
    since = fact.agg(F.date_sub(F.max("trading_date"), days).alias("since"))
    return fact.filter(F.col("trading_date") >= since.scalar())


def tickers(fact: DataFrame) -> DataFrame:
    return fact.select("ticker").distinct().orderBy("ticker")


def _ordered(df: DataFrame, ordered: bool, *order) -> DataFrame:
    """The report order; off where the rows only feed another step, as a sort is
    a shuffle of its own."""
    return df.orderBy(*order) if ordered else df


def _first_last(price: str = "close_price") -> tuple[Column, Column]:
    return F.min_by(price, "trading_date"), F.max_by(price, "trading_date")


# Dashboard sources -----------------------------------------------------------


def latest_snapshot(
    fact: DataFrame,
    companies: DataFrame,
    ordered: bool = True,
    dates: DataFrame | None = None,
) -> DataFrame:
    """State of every ticker on the latest date, with its company attributes."""
    about = companies.select("ticker", "industry", "market_cap_category", "exchange")
    rows = (
        on_latest_date(fact, dates)
        .drop("industry")
        .join(about, "ticker")
        .select(
            "ticker", "company_name", "sector", "industry", "market_cap_category",
            "exchange",
            F.col("close_price").alias("latest_close"),
            (F.col("daily_return_pct") / 100).alias("daily_return_pct"),
            "volume", "sma_30d", "sma_200d",
            rnd(F.col("volatility_20d_annualized") / 100, 4).alias("volatility_20d_pct"),
            F.col("trading_date").alias("as_of_date"),
        )
    )
    return _ordered(rows, ordered, "company_name")


def price_history(fact: DataFrame, ticker: str | None = None) -> DataFrame:
    """Prices and signals per ticker in order of date."""
    rows = fact if ticker is None else fact.filter(F.col("ticker") == ticker)
    rows = rows.select(
        "ticker", "trading_date", "open_price", "high_52w", "low_52w", "close_price",
        "volume", "daily_return_pct", "log_return_pct", "sma_30d", "sma_200d",
        "volatility_20d_annualized", "price_position_52w", "relative_volume_20d",
    )
    percent = ["daily_return_pct", "log_return_pct", "volatility_20d_annualized"]
    return as_fraction(rows, percent).orderBy("ticker", "trading_date")


def macro_indicators(fact: DataFrame, ticker: str | Column) -> DataFrame:
    """Macro context by date, read off the rows of one ticker."""
    rows = fact.filter(F.col("ticker") == ticker).select("trading_date", *MACRO_COLUMNS)
    return as_fraction(rows, MACRO_PERCENT).orderBy("trading_date")


def macro_vs_stocks(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """Daily returns beside rates, with the rate regime of the day."""
    percent = [
        "daily_return_pct", "fed_funds_rate", "treasury_yield_10y",
        "unemployment_rate", "breakeven_inflation_10y", "real_yield_10y",
        "volatility_20d_annualized",
    ]
    rows = fact.filter(F.col("fed_funds_rate").isNotNull()).select(
        "trading_date", "ticker", *percent,
        rate_regime(F.col("fed_funds_rate")).alias("rate_regime"),
    )
    return _ordered(as_fraction(rows, percent), ordered, "trading_date", "ticker")


def performance_52w(
    fact: DataFrame, ordered: bool = True, is_cut: bool = False
) -> DataFrame:
    """First to last close of the trailing year, with average risk and volume.
    ``is_cut`` says that the rows are those of the year alone."""
    first, last = _first_last()
    rows = (
        (fact if is_cut else in_trailing_year(fact))
        .groupBy("ticker", "company_name", "sector")
        .agg(
            first.alias("price_52w_ago"),
            last.alias("price_now"),
            rnd(ratio(last, first) - 1, 4).alias("return_52w_pct"),
            rnd(exact_avg(F.col("volatility_20d_annualized")) / 100, 4).alias(
                "avg_volatility_pct"
            ),
            rnd(F.avg("volume"), 0).alias("avg_daily_volume"),
        )
    )
    return _ordered(rows, ordered, F.desc("return_52w_pct"), "ticker")


def monthly_returns(fact: DataFrame, ticker: str | None = None) -> DataFrame:
    """First to last close within each month."""
    rows = fact if ticker is None else fact.filter(F.col("ticker") == ticker)
    first, last = _first_last()
    return (
        rows.groupBy("ticker", F.trunc("trading_date", "MM").alias("month"))
        .agg(
            rnd(ratio(last, first) - 1, 4).alias("monthly_return_pct"),
            F.count("*").alias("trading_days"),
        )
        .orderBy("ticker", "month")
    )


def sector_summary(fact: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Sectors on the latest date."""
    above = ratio(F.col("close_price"), F.col("sma_200d")) - 1
    return (
        on_latest_date(fact, dates)
        .groupBy("sector")
        .agg(
            F.countDistinct("ticker").alias("num_stocks"),
            rnd(exact_avg(F.col("daily_return_pct")) / 100, 6).alias(
                "avg_daily_return_pct"
            ),
            rnd(exact_avg(F.col("volatility_20d_annualized")) / 100, 4).alias(
                "avg_volatility_20d_pct"
            ),
            rnd(F.avg("volume"), 0).alias("avg_volume"),
            rnd(steady_avg(above), 4).alias("avg_pct_above_200sma"),
        )
        .orderBy(F.desc("avg_daily_return_pct"))
    )


# Dashboard pages -------------------------------------------------------------


def market_summary(snapshot: DataFrame) -> DataFrame:
    """Whole market on the latest date in one row."""
    change = F.col("daily_return_pct")
    return snapshot.agg(
        F.count("*").alias("num_stocks"),
        rnd(steady_avg(change), 3).alias("avg_daily_return"),
        F.count_if(change > 0).alias("gainers"),
        F.count_if(change < 0).alias("losers"),
        F.max("as_of_date").alias("as_of_date"),
    )


def best_performer(performance: DataFrame) -> DataFrame:
    return _first_of(performance, F.desc_nulls_last("return_52w_pct"))


def worst_performer(performance: DataFrame) -> DataFrame:
    return _first_of(performance, F.asc_nulls_last("return_52w_pct"))


def _first_of(performance: DataFrame, order: Column) -> DataFrame:
    return (
        performance.select("ticker", "company_name", "return_52w_pct")
        .orderBy(order, "ticker")
        .limit(1)
    )


def macro_latest(indicators: DataFrame) -> DataFrame:
    return indicators.orderBy(F.desc("trading_date")).limit(1)


def regime_performance(versus: DataFrame) -> DataFrame:
    """Returns by interest-rate regime."""
    change = F.col("daily_return_pct")
    return (
        versus.groupBy("rate_regime")
        .agg(
            rnd(steady_avg(change), 4).alias("avg_daily_return"),
            rnd(steady_stddev(change, FRACTION), 4).alias("std_daily_return"),
            F.count("*").alias("observations"),
        )
        .orderBy(F.desc("avg_daily_return"))
    )


def ticker_stats(
    history: DataFrame, ticker: str | None = None, is_cut: bool = False
) -> DataFrame:
    """Trailing-year figures of one ticker, or of each.  ``is_cut`` says that the rows
    are those of the year alone."""
    rows = history if is_cut else in_trailing_year(history)
    if ticker is not None:
        rows = rows.filter(F.col("ticker") == ticker)
    close, change = F.col("close_price"), F.col("daily_return_pct")
    return rows.groupBy("ticker").agg(
        rnd(F.min(close), 2).alias("low_52w"),
        rnd(F.max(close), 2).alias("high_52w"),
        rnd(exact_avg(close), 2).alias("avg_close"),
        rnd(F.avg("volume"), 0).alias("avg_volume"),
        rnd(steady_avg(change), 4).alias("avg_daily_return"),
        rnd(steady_stddev(change, FRACTION), 4).alias("std_daily_return"),
        F.count("*").alias("trading_days"),
    )


def stock_info(snapshot: DataFrame, ticker: str | Column) -> DataFrame:
    return snapshot.filter(F.col("ticker") == ticker).select(
        "ticker", "company_name", "sector", "industry", "market_cap_category", "exchange"
    )


# Daily briefing --------------------------------------------------------------


def daily_movers(
    fact: DataFrame, ordered: bool = True, dates: DataFrame | None = None
) -> DataFrame:
    """Tickers on the latest date, best return first."""
    above = ratio(F.col("close_price"), F.col("sma_200d")) - 1
    rows = (
        on_latest_date(fact, dates)
        .filter(F.col("daily_return_pct").isNotNull())
        .select(
            "ticker", "company_name", "sector",
            rnd(F.col("close_price"), 2).alias("close_price"),
            rnd(F.col("daily_return_pct"), 3).alias("daily_return_pct"),
            rnd(F.col("volatility_20d_annualized"), 1).alias("vol_20d_pct"),
            rnd(above, 3).alias("pct_vs_200sma"),
            rnd(F.col("price_position_52w") * 100, 1).alias("position_52w_pct"),
        )
    )
    return _ordered(rows, ordered, F.desc("daily_return_pct"), "ticker")


def briefing_52w(fact: DataFrame, ordered: bool = True) -> DataFrame:
    """Trailing-year return per ticker in percent."""
    first, last = _first_last()
    change = (ratio(last, first) - 1) * 100
    rows = (
        in_trailing_year(fact)
        .groupBy("ticker", "company_name")
        .agg(rnd(change, 1).alias("return_52w_pct"))
    )
    return _ordered(rows, ordered, F.desc("return_52w_pct"), "ticker")


def latest_per_ticker(fact: DataFrame) -> DataFrame:
    """Last row of every ticker; Spark keeps one candidate per ticker and task
    before it shuffles."""
    newest = Window.partitionBy("ticker").orderBy(F.desc("trading_date"))
    return (
        fact.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").drop("rn")
    )


def briefing_macro(fact: DataFrame, ticker: str | Column) -> DataFrame:
    """Macro context of the latest date, read off one ticker."""
    digits = {
        "fed_funds_rate": 2,
        "treasury_yield_10y": 2,
        "real_yield_10y": 2,
        "unemployment_rate": 1,
        "breakeven_inflation_10y": 2,
        "gdp_growth_rate": 1,
    }
    return on_latest_date(fact).filter(F.col("ticker") == ticker).select(
        *[rnd(F.col(c), n).alias(c) for c, n in digits.items()]
    )


def briefing_sectors(fact: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    return (
        on_latest_date(fact, dates)
        .groupBy("sector")
        .agg(
            rnd(exact_avg(F.col("daily_return_pct")), 3).alias("avg_return"),
            rnd(exact_avg(F.col("volatility_20d_annualized")), 1).alias("avg_vol"),
        )
        .orderBy(F.desc("avg_return"), "sector")
    )


def market_facts(movers: DataFrame, performance: DataFrame) -> DataFrame:
    """Gainers, losers and extremes of the day and of the year, in one row.

    Both inputs have one row per ticker; they are stacked and folded in one
    aggregate.  Of equal returns the first ticker by name counts.
    """
    day = movers.select("ticker", F.col("daily_return_pct").alias("day"))
    year = performance.select("ticker", F.col("return_52w_pct").alias("year"))

    def ends(change: str, high: str, low: str) -> list[Column]:
        c = F.col(change)
        best = F.when(c.isNotNull(), F.struct(-c, "ticker"))
        worst = F.when(c.isNotNull(), F.struct(c, "ticker"))
        return [
            F.min_by("ticker", best).alias(high),
            F.max(c).alias(f"{high}_pct"),
            F.min_by("ticker", worst).alias(low),
            F.min(c).alias(f"{low}_pct"),
        ]

    return day.unionByName(year, allowMissingColumns=True).agg(
        F.count_if(F.col("day") > 0).alias("gainers"),
        F.count_if(F.col("day") < 0).alias("losers"),
        *ends("day", "top_gainer", "top_loser"),
        *ends("year", "best_52w", "worst_52w"),
    )
