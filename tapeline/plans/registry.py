"""Every operator as a query over the driver tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators import macro, performance, quality, reports, signals, staging
from tapeline.plans import daily_run, marts
from tapeline.plans.data_tests import data_tests as run_data_tests
from tapeline.sources import driver_tables as raw
from tapeline.sources import shaping, writers
from tapeline.sources.folders import work_folder
from tapeline.sources.schemas import PRICES, SEED
from tapeline.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the oracle uses the same.
CALENDAR = (dt.date(1995, 1, 1), dt.date(2002, 1, 1))
SHORT_CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 1, 1))
AS_OF = dt.date(2001, 11, 4)
NOW = dt.datetime(2001, 11, 6, 12, 0, 0)
TICKER = "Supplier#000000001"
MIN_ROWS = 500
SLICE_ROWS = 300
ORPHAN_NATION = 3
SLOTS = 1
LATE, WRONG = "1998-05", "1999-03"
HISTORY = (dt.date(1998, 1, 1), dt.date(2000, 1, 1))

QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Market], DataFrame]) -> Query:
    """Register a query under the name of its function."""

    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Market(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


class Market:
    """The input frames of one data directory, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw_prices(self) -> DataFrame:
        return raw.raw_prices(self.spark, self.dir)

    def dirty_prices(self) -> DataFrame:
        return raw.dirty_prices(self.spark, self.dir)

    def raw_indicators(self) -> DataFrame:
        return raw.raw_indicators(self.spark, self.dir)

    def stg(self) -> DataFrame:
        return staging.stg_stock_prices(self.raw_prices())

    def dirty_stg(self) -> DataFrame:
        return staging.stg_stock_prices(self.dirty_prices())

    def companies(self) -> DataFrame:
        return staging.stg_company_info(raw.raw_companies(self.spark, self.dir))

    def indicators(self) -> DataFrame:
        return staging.stg_economic_indicators(self.raw_indicators())

    def signals(self) -> DataFrame:
        return signals.daily_signals(self.stg())

    def macro(self) -> DataFrame:
        return macro.int_macro_context(self.stg(), self.indicators())

    def with_companies(self) -> DataFrame:
        return marts.with_companies(self.signals(), self.companies())

    def with_macro(self) -> DataFrame:
        return marts.with_macro(self.signals(), self.macro())

    def fact(self) -> DataFrame:
        return marts.fct_daily_trading(self.stg(), self.companies(), self.indicators())

    def dim_company(self) -> DataFrame:
        return marts.dim_company(self.companies())

    def latest(self) -> DataFrame:
        """Last bar of each ticker: all that reports on the latest date read."""
        return marts.with_companies(signals.latest_signals(self.stg()), self.companies())

    def snapshot(self, ordered: bool = False) -> DataFrame:
        return reports.latest_snapshot(
            self.latest(), self.dim_company(), ordered, self.stg()
        )

    def trailing(self, reach: int) -> DataFrame:
        """Signals of the trailing year alone."""
        return signals.trailing_signals(self.stg(), reach=reach)

    def performance(self, ordered: bool = False) -> DataFrame:
        # the volatility of 20 returns, which lie between 21 bars
        rows = marts.with_companies(self.trailing(20), self.companies())
        return reports.performance_52w(rows, ordered, is_cut=True)

    def seed(self) -> DataFrame:
        """Reference list: every company, with its region and nation."""
        about = raw.raw_companies(self.spark, self.dir)
        nation = raw.table(self.spark, self.dir, "nation").select("n_nationkey", "n_name")
        home = raw.table(self.spark, self.dir, "supplier").select(
            F.col("s_name").alias("ticker"), F.col("s_nationkey").alias("n_nationkey")
        )
        rows = about.drop("sector").join(home, "ticker").join(nation, "n_nationkey")
        added = {"index_weight_pct": F.lit(0.0), "added_date": F.lit(AS_OF)}
        return rows.withColumnRenamed("n_name", "sector").withColumns(added).select(
            *[f.name for f in SEED]
        )

    def latest_ticker(self) -> Column:
        """The first ticker by name among those traded on the latest date."""
        traded = self.stg().groupBy("trading_date").agg(F.min("ticker").alias("ticker"))
        return traded.agg(F.max_by("ticker", "trading_date")).scalar()


# Staging and intermediate ----------------------------------------------------


@query
def stg_stock_prices(m: Market) -> DataFrame:
    return m.dirty_stg()


@query
def stg_company_info(m: Market) -> DataFrame:
    return m.companies()


@query
def stg_economic_indicators(m: Market) -> DataFrame:
    return m.indicators()


@query
def int_daily_returns(m: Market) -> DataFrame:
    return signals.int_daily_returns(m.stg())


@query
def int_moving_averages(m: Market) -> DataFrame:
    return signals.int_moving_averages(m.stg())


@query
def int_volatility(m: Market) -> DataFrame:
    return signals.int_volatility(m.stg())


@query
def sliced_signals(m: Market) -> DataFrame:
    """Every ticker cut into slices, as a ticker with most of the rows would be."""
    return signals.daily_signals(m.stg(), SLICE_ROWS)


@query
def incremental_signals(m: Market) -> DataFrame:
    """The signals kept by three batches of bars: the first lacks a month and has another
    one wrong, the second brings both, the third all later bars."""
    bars = m.raw_prices().withColumn("date", F.col("date").cast("timestamp_ntz"))
    # asked of every trade, so by days and not by their text
    month = F.trunc("date", "month")
    late, wrong = (month == F.to_date(F.lit(f"{name}-01")) for name in (LATE, WRONG))
    early = F.col("date") < HISTORY[1]
    batches = [
        bars.filter(early & ~late).withColumns(
            {
                "close": F.when(wrong, F.col("close") * 2).otherwise(F.col("close")),
                "extracted_at": F.lit(str(HISTORY[1])),
            }
        ),
        bars.filter(early & (late | wrong)),
        bars.filter(~early),
    ]
    target = work_folder(m.spark, "ingested")
    for n, batch in enumerate(batches):
        incremental.merge_and_refresh(batch, f"batch-{n}", target, SLOTS)
    return incremental.read_signals(m.spark, target)


@query
def pivot_indicators(m: Market) -> DataFrame:
    return macro.pivot_indicators(m.indicators())


@query
def int_macro_context(m: Market) -> DataFrame:
    return m.macro()


@query
def asof_macro_context(m: Market) -> DataFrame:
    return macro.asof_macro_context(m.stg(), m.indicators())


@query
def enrich_from_seed(m: Market) -> DataFrame:
    return staging.enrich_from_seed(m.companies(), m.seed())


# Star schema -----------------------------------------------------------------


@query
def dim_company(m: Market) -> DataFrame:
    return m.dim_company()


@query
def date_spine(m: Market) -> DataFrame:
    """The days between the first and the last bar."""
    ends = m.stg().agg(F.min("trading_date").alias("a"), F.max("trading_date").alias("b"))
    return ends.select(F.explode(F.sequence("a", "b")).alias("calendar_date"))


@query
def dim_date(m: Market) -> DataFrame:
    return marts.dim_date(m.stg(), *CALENDAR, as_of=AS_OF)


@query
def fct_daily_trading(m: Market) -> DataFrame:
    return m.fact()


# Reports ---------------------------------------------------------------------


@query
def as_of_date(m: Market) -> DataFrame:
    return reports.as_of_date(m.stg())


@query
def tickers(m: Market) -> DataFrame:
    return reports.tickers(m.stg())


@query
def latest_snapshot(m: Market) -> DataFrame:
    return m.snapshot(ordered=True)


@query
def latest_per_ticker(m: Market) -> DataFrame:
    rows = m.stg().select("ticker", "trading_date", "close_price")
    return reports.latest_per_ticker(rows)


@query
def price_history(m: Market) -> DataFrame:
    ordered = signals.ranged_by_ticker(m.stg())
    return reports.price_history(signals.daily_signals(ordered))


@query
def ticker_history(m: Market) -> DataFrame:
    return reports.price_history(m.signals(), TICKER)


@query
def macro_indicators(m: Market) -> DataFrame:
    return reports.macro_indicators(m.with_macro(), m.latest_ticker())


@query
def macro_latest(m: Market) -> DataFrame:
    return reports.macro_latest(macro_indicators(m.spark, m.dir))


@query
def macro_vs_stocks(m: Market) -> DataFrame:
    return reports.macro_vs_stocks(m.with_macro())


@query
def regime_performance(m: Market) -> DataFrame:
    return reports.regime_performance(
        reports.macro_vs_stocks(m.with_macro(), ordered=False)
    )


@query
def performance_52w(m: Market) -> DataFrame:
    return m.performance(ordered=True)


@query
def best_performer(m: Market) -> DataFrame:
    return reports.best_performer(m.performance())


@query
def worst_performer(m: Market) -> DataFrame:
    return reports.worst_performer(m.performance())


@query
def monthly_returns(m: Market) -> DataFrame:
    return reports.monthly_returns(m.stg())


@query
def ticker_monthly(m: Market) -> DataFrame:
    return reports.monthly_returns(m.stg(), TICKER)


@query
def sector_summary(m: Market) -> DataFrame:
    return reports.sector_summary(m.latest(), m.stg())


@query
def market_summary(m: Market) -> DataFrame:
    return reports.market_summary(m.snapshot())


@query
def ticker_stats(m: Market) -> DataFrame:
    # returns look one bar back
    rows = reports.as_fraction(m.trailing(1), ["daily_return_pct"])
    return reports.ticker_stats(rows, is_cut=True)


@query
def stock_info(m: Market) -> DataFrame:
    return reports.stock_info(m.snapshot(), m.latest_ticker())


@query
def daily_movers(m: Market) -> DataFrame:
    return reports.daily_movers(m.latest(), dates=m.stg())


@query
def briefing_52w(m: Market) -> DataFrame:
    return reports.briefing_52w(marts.with_companies(m.stg(), m.companies()))


@query
def briefing_macro(m: Market) -> DataFrame:
    return reports.briefing_macro(m.with_macro(), m.latest_ticker())


@query
def briefing_sectors(m: Market) -> DataFrame:
    return reports.briefing_sectors(m.latest(), m.stg())


@query
def market_facts(m: Market) -> DataFrame:
    bars = marts.with_companies(m.stg(), m.companies())
    return reports.market_facts(
        reports.daily_movers(m.latest(), ordered=False, dates=m.stg()),
        reports.briefing_52w(bars, ordered=False),
    )


# Long-run figures ------------------------------------------------------------


@query
def cagr_by_ticker(m: Market) -> DataFrame:
    return performance.cagr_by_ticker(m.stg())


@query
def sharpe_by_ticker(m: Market) -> DataFrame:
    return performance.sharpe_by_ticker(m.with_macro())


@query
def drawdown_series(m: Market) -> DataFrame:
    return performance.drawdown_series(m.stg())


@query
def sliced_drawdown(m: Market) -> DataFrame:
    return performance.drawdown_series(m.stg(), cut=True)


@query
def max_drawdown_by_ticker(m: Market) -> DataFrame:
    return performance.max_drawdown_by_ticker(performance.drawdown_series(m.stg()))


# Sources ---------------------------------------------------------------------


@query
def concat_by_name(m: Market) -> DataFrame:
    """Bars from two deliveries, the older one without volume."""
    bars = m.raw_prices().drop("extracted_at")
    old, new = F.col("date") < HISTORY[0], F.col("date") >= HISTORY[0]
    return shaping.concat_by_name(
        [bars.filter(new), bars.filter(old).drop("volume")]
    )


@query
def normalized_and_stamped(m: Market) -> DataFrame:
    """Orders with display names, brought to snake case and marked."""
    orders = raw.table(m.spark, m.dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("Observation Date"),
        F.col("o_totalprice").alias("Value"),
        F.col("o_orderkey").alias("Order Key"),
    )
    return shaping.stamp(
        shaping.normalize_columns(orders), raw.EXTRACTED_AT, series_id="TOTAL"
    )


@query
def restrict_history(m: Market) -> DataFrame:
    return shaping.restrict_history(m.raw_prices(), "date", *HISTORY)


@query
def restrict_macro_history(m: Market) -> DataFrame:
    return shaping.restrict_history(
        m.raw_indicators(), "observation_date", *HISTORY, through_end=True
    )


@query
def infer_frequency(m: Market) -> DataFrame:
    return shaping.infer_frequency(m.raw_indicators())


@query
def extract_stats(m: Market) -> DataFrame:
    return shaping.extract_stats(m.raw_indicators(), "series_id", "observation_date")


@query
def extract_stats_prices(m: Market) -> DataFrame:
    return shaping.extract_stats(m.raw_prices(), "ticker", "date")


@query
def load_summary(m: Market) -> DataFrame:
    tables = {
        "raw_stock_prices": m.raw_prices(),
        "raw_company_info": raw.raw_companies(m.spark, m.dir),
        "raw_economic_indicators": m.raw_indicators(),
    }
    return writers.load_summary(m.spark, tables)


# Quality ---------------------------------------------------------------------


@query
def valid_ohlc(m: Market) -> DataFrame:
    return quality.valid_ohlc(m.dirty_stg())


@query
def positive_volume(m: Market) -> DataFrame:
    return quality.positive_volume(m.dirty_prices())


@query
def reasonable_daily_return(m: Market) -> DataFrame:
    return quality.reasonable_daily_return(m.signals())


@query
def reasonable_volatility(m: Market) -> DataFrame:
    return quality.reasonable_volatility(m.signals())


@query
def no_large_date_gaps(m: Market) -> DataFrame:
    return quality.no_large_date_gaps(m.stg())


@query
def sufficient_history(m: Market) -> DataFrame:
    return quality.sufficient_history(m.stg(), MIN_ROWS)


@query
def tickers_in_dim(m: Market) -> DataFrame:
    kept = raw.companies_without(m.spark, m.dir, ORPHAN_NATION)
    return quality.tickers_in_dim(m.stg(), staging.stg_company_info(kept))


@query
def dates_in_dim(m: Market) -> DataFrame:
    return quality.dates_in_dim(m.stg(), marts.date_spine(m.spark, *SHORT_CALENDAR))


@query
def not_null(m: Market) -> DataFrame:
    return quality.not_null(m.dirty_prices().drop("extracted_at"), "close")


@query
def unique(m: Market) -> DataFrame:
    return quality.unique(m.dirty_stg(), "price_id")


@query
def freshness(m: Market) -> DataFrame:
    return quality.freshness(m.raw_prices(), now=NOW)


@query
def freshness_macro(m: Market) -> DataFrame:
    return quality.freshness(
        m.raw_indicators(), warn=quality.MACRO_WARN, error=quality.MACRO_ERROR, now=NOW
    )


@query
def check_schema(m: Market) -> DataFrame:
    return quality.check_schema(m.raw_prices(), PRICES)


@query
def quality_report(m: Market) -> DataFrame:
    kept = staging.stg_company_info(
        raw.companies_without(m.spark, m.dir, ORPHAN_NATION)
    )
    calendar = marts.date_spine(m.spark, *SHORT_CALENDAR)
    return daily_run.checks(
        m.dirty_prices(), m.dirty_stg(), kept, calendar, MIN_ROWS
    )


@query
def data_tests(m: Market) -> DataFrame:
    """All declared tests over the clean tables."""
    stg, signs, about = m.stg(), m.signals(), m.companies()
    tables = {
        "raw_stock_prices": m.raw_prices(),
        "raw_company_info": raw.raw_companies(m.spark, m.dir),
        "raw_economic_indicators": m.raw_indicators(),
        "stg_stock_prices": stg,
        "stg_company_info": about,
        "stg_economic_indicators": m.indicators(),
        "int_daily_returns": signs.select(signals.RETURNS),
        "int_moving_averages": signs.select(signals.AVERAGES),
        "int_macro_context": m.macro(),
        "int_volatility": signs.select(signals.VOLATILITY),
        "fct_daily_trading": m.fact(),
        "dim_company": m.dim_company(),
        "dim_date": marts.dim_date(stg, *CALENDAR, as_of=AS_OF),
        "sp500_companies": m.seed(),
    }
    return run_data_tests(tables, MIN_ROWS)
