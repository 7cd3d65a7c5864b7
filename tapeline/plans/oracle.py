"""The registered queries as SQL over the driver tables, for comparison.

Shared steps are named common table expressions; ``oracle_sql`` puts in front of
each query the ones it builds on.
"""

from __future__ import annotations

import re

from tapeline.plans.data_tests import NOT_NULL, UNIQUE
from tapeline.plans.registry import (
    AS_OF, CALENDAR, HISTORY, MIN_ROWS, NOW, ORPHAN_NATION, SHORT_CALENDAR, TICKER,
)

AT = "'2001-11-05T00:00:00'"

STEPS: dict[str, str] = {
    # Raw tables ---------------------------------------------------------------
    "raw_prices": f"""
        SELECT bar.date, s_name AS ticker, bar.open, bar.high, bar.low, bar.close,
               bar.volume, {AT} AS extracted_at
        FROM (
            SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
                   min_by(l_extendedprice / l_quantity, k) AS open,
                   max(l_extendedprice / l_quantity) AS high,
                   min(l_extendedprice / l_quantity) AS low,
                   max_by(l_extendedprice / l_quantity, k) AS close,
                   CAST(sum(l_quantity) AS BIGINT) AS volume
            FROM (SELECT *, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)
                         AS k FROM lineitem)
            GROUP BY ALL
        ) bar JOIN supplier ON s_suppkey = bar.l_suppkey""",
    "dirty_prices": """
        SELECT date, ticker, open,
               CASE WHEN day(date) = 17 THEN low ELSE high END AS high,
               CASE WHEN day(date) = 17 THEN high ELSE low END AS low,
               CASE WHEN day(date) <> 19 THEN close END AS close,
               CAST(CASE WHEN day(date) = 13 THEN 0 ELSE volume END AS BIGINT) AS volume,
               extracted_at
        FROM (SELECT * FROM raw_prices
              UNION ALL SELECT * FROM raw_prices WHERE day(date) = 23)""",
    "raw_companies": f"""
        SELECT s_name AS ticker, s_name AS company_name,
               CASE WHEN s_nationkey % 7 <> 0 THEN n_name END AS sector,
               r_name AS industry,
               CASE WHEN s_acctbal >= 0 THEN CAST(trunc(s_acctbal * 2e8) AS BIGINT)
               END AS market_cap,
               CAST(NULL AS VARCHAR) AS currency, 'X' AS exchange, r_name AS country,
               CAST(NULL AS VARCHAR) AS website, {AT} AS extracted_at, s_nationkey
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "raw_indicators": f"""
        SELECT observation_date, value, series_id, series_name, frequency,
               {AT} AS extracted_at
        FROM (
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS observation_date,
                   min_by(o_totalprice, o_orderkey) / 80000 AS value,
                   'FEDFUNDS' AS series_id, 'Federal funds rate' AS series_name,
                   'monthly' AS frequency FROM orders GROUP BY 1
            UNION ALL
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE),
                   max_by(o_totalprice, o_orderkey) / 1000,
                   'CPIAUCSL', 'Consumer prices', 'monthly' FROM orders GROUP BY 1
            UNION ALL
            SELECT CAST(date_trunc('month', o_orderdate) AS DATE),
                   min_by(o_totalprice, o_orderkey) / 50000,
                   'UNRATE', 'Unemployment rate', 'monthly' FROM orders
            WHERE o_orderpriority = '5-LOW' GROUP BY 1
            UNION ALL
            SELECT CAST(o_orderdate AS DATE),
                   min_by(o_totalprice, o_orderkey) / 80000,
                   'DGS10', '10-year yield', 'daily' FROM orders GROUP BY 1
            UNION ALL
            SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE),
                   max_by(o_totalprice, o_orderkey) / 80000 - 3,
                   'A191RL1Q225SBEA', 'GDP growth', 'quarterly' FROM orders GROUP BY 1
            UNION ALL
            SELECT CAST(o_orderdate AS DATE),
                   max_by(o_totalprice, o_orderkey) / 160000,
                   'T10YIE', '10-year breakeven', 'daily' FROM orders GROUP BY 1
        )""",
    # Staging ------------------------------------------------------------------
    "stg": "{staged:raw_prices}",
    "dirty_stg": "{staged:dirty_prices}",
    "companies": """
        SELECT ticker, company_name, coalesce(sector, 'Unknown') AS sector,
               coalesce(industry, 'Unknown') AS industry, market_cap,
               coalesce(currency, 'USD') AS currency, exchange,
               coalesce(country, 'Unknown') AS country, website, extracted_at
        FROM raw_companies WHERE ticker IS NOT NULL""",
    "indicators": """
        SELECT series_id, series_name, observation_date, value, frequency, extracted_at
        FROM raw_indicators WHERE observation_date IS NOT NULL AND value IS NOT NULL""",
    # Signals ------------------------------------------------------------------
    "returns": "{returned:stg}",
    "signals": "{signalled:returns}",
    "dirty_returns": "{returned:dirty_stg}",
    "dirty_signals": "{signalled:dirty_returns}",
    # Macro --------------------------------------------------------------------
    "days": "SELECT DISTINCT trading_date AS calendar_date FROM stg",
    "wide": """
        SELECT observation_date,
               max(value) FILTER (series_id = 'FEDFUNDS') AS fed_funds_rate,
               max(value) FILTER (series_id = 'CPIAUCSL') AS cpi,
               max(value) FILTER (series_id = 'UNRATE') AS unemployment_rate,
               max(value) FILTER (series_id = 'DGS10') AS treasury_yield_10y,
               max(value) FILTER (series_id = 'A191RL1Q225SBEA') AS gdp_growth_rate,
               max(value) FILTER (series_id = 'T10YIE') AS breakeven_inflation_10y
        FROM indicators GROUP BY observation_date""",
    "filled": """
        SELECT calendar_date,
               last_value(fed_funds_rate IGNORE NULLS) OVER f AS fed_funds_rate,
               last_value(cpi IGNORE NULLS) OVER f AS cpi,
               last_value(unemployment_rate IGNORE NULLS) OVER f AS unemployment_rate,
               last_value(treasury_yield_10y IGNORE NULLS) OVER f AS treasury_yield_10y,
               last_value(gdp_growth_rate IGNORE NULLS) OVER f AS gdp_growth_rate,
               last_value(breakeven_inflation_10y IGNORE NULLS) OVER f
                   AS breakeven_inflation_10y
        FROM days LEFT JOIN wide ON calendar_date = observation_date
        WINDOW f AS (ORDER BY calendar_date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "macro": """
        SELECT *, round(treasury_yield_10y - breakeven_inflation_10y, 4)
                  AS real_yield_10y FROM filled""",
    # Marts --------------------------------------------------------------------
    "fact": """
        SELECT s.price_id, s.ticker, s.trading_date, s.open_price, s.close_price,
               s.prev_close_price, s.daily_return_pct, s.log_return_pct,
               s.overnight_gap_pct, s.sma_7d, s.sma_30d, s.sma_90d, s.sma_200d,
               s.volume, s.avg_volume_20d, s.avg_volume_90d, s.relative_volume_20d,
               s.high_52w, s.low_52w, s.price_position_52w,
               s.volatility_20d_annualized, s.volatility_60d_annualized,
               s.avg_intraday_range_pct_20d,
               m.fed_funds_rate, m.cpi, m.unemployment_rate, m.treasury_yield_10y,
               m.gdp_growth_rate, m.breakeven_inflation_10y, m.real_yield_10y,
               c.company_name, c.sector, c.industry
        FROM signals s
        LEFT JOIN macro m ON m.calendar_date = s.trading_date
        LEFT JOIN companies c ON c.ticker = s.ticker""",
    "dim_company_t": """
        SELECT md5(ticker) AS company_key, ticker, company_name, sector, industry,
               market_cap,
               CASE WHEN market_cap IS NULL THEN 'Unknown'
                    WHEN market_cap >= 1000000000000 THEN 'Mega Cap (>$1T)'
                    WHEN market_cap >= 200000000000 THEN 'Large Cap ($200B–$1T)'
                    WHEN market_cap >= 10000000000 THEN 'Mid Cap ($10B–$200B)'
                    WHEN market_cap >= 2000000000 THEN 'Small Cap ($2B–$10B)'
                    ELSE 'Micro Cap (<$2B)' END AS market_cap_category,
               currency, exchange, country, website, extracted_at
        FROM companies""",
    # Reports ------------------------------------------------------------------
    "latest": "SELECT * FROM fact WHERE trading_date = (SELECT max(trading_date) FROM stg)",
    "trailing_year": """
        SELECT * FROM fact
        WHERE trading_date >= (SELECT max(trading_date) - 365 FROM stg)""",
    "first_ticker": "SELECT min(ticker) AS t FROM latest",
    "snapshot": """
        SELECT f.ticker, f.company_name, f.sector, c.industry, c.market_cap_category,
               c.exchange, f.close_price AS latest_close,
               f.daily_return_pct / 100 AS daily_return_pct, f.volume, f.sma_30d,
               f.sma_200d,
               round(f.volatility_20d_annualized / 100, 4) AS volatility_20d_pct,
               f.trading_date AS as_of_date
        FROM latest f JOIN dim_company_t c ON c.ticker = f.ticker""",
    "history": """
        SELECT ticker, trading_date, open_price, high_52w, low_52w, close_price, volume,
               daily_return_pct / 100 AS daily_return_pct,
               log_return_pct / 100 AS log_return_pct, sma_30d, sma_200d,
               volatility_20d_annualized / 100 AS volatility_20d_annualized,
               price_position_52w, relative_volume_20d
        FROM fact""",
    "macro_rows": """
        SELECT trading_date, fed_funds_rate / 100 AS fed_funds_rate, cpi,
               unemployment_rate / 100 AS unemployment_rate,
               treasury_yield_10y / 100 AS treasury_yield_10y,
               gdp_growth_rate / 100 AS gdp_growth_rate,
               breakeven_inflation_10y / 100 AS breakeven_inflation_10y,
               real_yield_10y / 100 AS real_yield_10y
        FROM fact WHERE ticker = (SELECT t FROM first_ticker)""",
    "versus": """
        SELECT trading_date, ticker, daily_return_pct / 100 AS daily_return_pct,
               fed_funds_rate / 100 AS fed_funds_rate,
               treasury_yield_10y / 100 AS treasury_yield_10y,
               unemployment_rate / 100 AS unemployment_rate,
               breakeven_inflation_10y / 100 AS breakeven_inflation_10y,
               real_yield_10y / 100 AS real_yield_10y,
               volatility_20d_annualized / 100 AS volatility_20d_annualized,
               CASE WHEN fed_funds_rate >= 5 THEN 'High Rates (≥5%)'
                    WHEN fed_funds_rate >= 3 THEN 'Elevated Rates (3–5%)'
                    WHEN fed_funds_rate >= 1 THEN 'Normal Rates (1–3%)'
                    ELSE 'Low Rates (<1%)' END AS rate_regime
        FROM fact WHERE fed_funds_rate IS NOT NULL""",
    "perf": """
        SELECT ticker, company_name, sector,
               min_by(close_price, trading_date) AS price_52w_ago,
               max_by(close_price, trading_date) AS price_now,
               round(max_by(close_price, trading_date)
                     / nullif(min_by(close_price, trading_date), 0) - 1, 4)
                   AS return_52w_pct,
               round({exact_avg:volatility_20d_annualized} / 100, 4)
                   AS avg_volatility_pct,
               round(avg(volume), 0) AS avg_daily_volume
        FROM trailing_year GROUP BY ticker, company_name, sector""",
    "months": """
        SELECT ticker, CAST(date_trunc('month', trading_date) AS DATE) AS month,
               round(max_by(close_price, trading_date)
                     / nullif(min_by(close_price, trading_date), 0) - 1, 4)
                   AS monthly_return_pct,
               count(*) AS trading_days
        FROM stg GROUP BY ALL""",
    "movers": """
        SELECT ticker, company_name, sector, round(close_price, 2) AS close_price,
               round(daily_return_pct, 3) AS daily_return_pct,
               round(volatility_20d_annualized, 1) AS vol_20d_pct,
               round(close_price / nullif(sma_200d, 0) - 1, 3) AS pct_vs_200sma,
               round(price_position_52w * 100, 1) AS position_52w_pct
        FROM latest WHERE daily_return_pct IS NOT NULL""",
    "perf_brief": """
        SELECT ticker, company_name,
               round((max_by(close_price, trading_date)
                      / nullif(min_by(close_price, trading_date), 0) - 1) * 100, 1)
                   AS return_52w_pct
        FROM trailing_year GROUP BY ticker, company_name""",
    "falls": """
        SELECT ticker, trading_date, close_price,
               round(close_price / nullif(max(close_price) OVER (
                   PARTITION BY ticker ORDER BY trading_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - 1, 4)
                   AS drawdown
        FROM stg""",
    # Quality ------------------------------------------------------------------
    "gaps": "{gapped:stg}",
    "dirty_gaps": "{gapped:dirty_stg}",
    "kept_companies": f"SELECT * FROM raw_companies WHERE s_nationkey <> {ORPHAN_NATION}",
    "seed": """
        SELECT s_name AS ticker, s_name AS company_name, n_name AS sector
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "calendar": f"""
        SELECT CAST(d AS DATE) AS calendar_date
        FROM range(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY) t(d)""",
    "short_dates": f"""
        SELECT CAST(d AS DATE) AS calendar_date
        FROM range(DATE '{SHORT_CALENDAR[0]}', DATE '{SHORT_CALENDAR[1]}',
                   INTERVAL 1 DAY) t(d)""",
}

# Steps that run on clean and on dirty bars, by name and input.
TEMPLATES: dict[str, str] = {
    "staged": """
        SELECT md5(ticker || '-' || CAST(date AS VARCHAR)) AS price_id, ticker,
               date AS trading_date, round(open, 4) AS open_price,
               round(high, 4) AS high_price, round(low, 4) AS low_price,
               round(close, 4) AS close_price, volume,
               round(high - low, 4) AS intraday_range,
               round((close - open) / nullif(open, 0) * 100, 4) AS intraday_return_pct,
               extracted_at
        FROM INPUT WHERE date IS NOT NULL AND close IS NOT NULL AND volume > 0""",
    "returned": """
        SELECT *,
               round((close_price - p) / nullif(p, 0) * 100, 4) AS daily_return_pct,
               round(CASE WHEN close_price / nullif(p, 0) > 0
                          THEN ln(close_price / nullif(p, 0)) END * 100, 4)
                   AS log_return_pct,
               round((open_price - p) / nullif(p, 0) * 100, 4) AS overnight_gap_pct,
               round((high_price - low_price) / nullif(close_price, 0) * 100, 4) AS r,
               p AS prev_close_price
        FROM (SELECT *, lag(close_price) OVER
                     (PARTITION BY ticker ORDER BY trading_date) AS p FROM INPUT)""",
    "signalled": """
        SELECT * EXCLUDE (p, r),
               round(CAST(sum(CAST(close_price AS DECIMAL(18, 4))) OVER w7 AS DOUBLE)
                     / count(*) OVER w7, 4) AS sma_7d,
               round(CAST(sum(CAST(close_price AS DECIMAL(18, 4))) OVER w30 AS DOUBLE)
                     / count(*) OVER w30, 4) AS sma_30d,
               round(CAST(sum(CAST(close_price AS DECIMAL(18, 4))) OVER w90 AS DOUBLE)
                     / count(*) OVER w90, 4) AS sma_90d,
               round(CAST(sum(CAST(close_price AS DECIMAL(18, 4))) OVER w200 AS DOUBLE)
                     / count(*) OVER w200, 4) AS sma_200d,
               round(avg(volume) OVER w20, 0) AS avg_volume_20d,
               round(avg(volume) OVER w90, 0) AS avg_volume_90d,
               round(volume / nullif(avg(volume) OVER (
                   PARTITION BY ticker ORDER BY trading_date
                   ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0), 2)
                   AS relative_volume_20d,
               max(close_price) OVER w252 AS high_52w,
               min(close_price) OVER w252 AS low_52w,
               round((close_price - min(close_price) OVER w252)
                     / nullif(max(close_price) OVER w252
                              - min(close_price) OVER w252, 0), 4)
                   AS price_position_52w,
               round(stddev_samp(log_return_pct / 100) OVER w20 * sqrt(252) * 100, 4)
                   AS volatility_20d_annualized,
               round(stddev_samp(log_return_pct / 100) OVER w60 * sqrt(252) * 100, 4)
                   AS volatility_60d_annualized,
               round(CAST(sum(CAST(r AS DECIMAL(18, 4))) OVER w20 AS DOUBLE)
                     / count(r) OVER w20, 4) AS avg_intraday_range_pct_20d
        FROM INPUT
        WINDOW w7 AS (PARTITION BY ticker ORDER BY trading_date ROWS 6 PRECEDING),
               w20 AS (PARTITION BY ticker ORDER BY trading_date ROWS 19 PRECEDING),
               w30 AS (PARTITION BY ticker ORDER BY trading_date ROWS 29 PRECEDING),
               w60 AS (PARTITION BY ticker ORDER BY trading_date ROWS 59 PRECEDING),
               w90 AS (PARTITION BY ticker ORDER BY trading_date ROWS 89 PRECEDING),
               w200 AS (PARTITION BY ticker ORDER BY trading_date ROWS 199 PRECEDING),
               w252 AS (PARTITION BY ticker ORDER BY trading_date ROWS 251 PRECEDING)""",
    "gapped": """
        SELECT *, datediff('day', prev_trading_date, trading_date) AS gap_days
        FROM (SELECT *, lag(trading_date) OVER
                     (PARTITION BY ticker ORDER BY trading_date) AS prev_trading_date
              FROM INPUT)""",
    "exact_avg": "CAST(sum(CAST(INPUT AS DECIMAL(18, 4))) AS DOUBLE) / count(INPUT)",
}

INDICATOR_ROW = ", ".join(
    f"(SELECT max_by(value, observation_date) FROM indicators "
    f"WHERE series_id = '{series}' AND observation_date <= calendar_date) AS {column}"
    for series, column in [
        ("FEDFUNDS", "fed_funds_rate"),
        ("CPIAUCSL", "cpi"),
        ("UNRATE", "unemployment_rate"),
        ("DGS10", "treasury_yield_10y"),
        ("A191RL1Q225SBEA", "gdp_growth_rate"),
        ("T10YIE", "breakeven_inflation_10y"),
    ]
)

DIM_DATE = f"""
    SELECT calendar_date, CAST(year(calendar_date) AS INTEGER) AS year,
           CAST(month(calendar_date) AS INTEGER) AS month_num,
           CAST(day(calendar_date) AS INTEGER) AS day_of_month,
           CAST(quarter(calendar_date) AS INTEGER) AS quarter_num,
           CAST(dayofweek(calendar_date) AS INTEGER) AS day_of_week,
           CAST(dayofyear(calendar_date) AS INTEGER) AS day_of_year,
           CAST(weekofyear(calendar_date) AS INTEGER) AS week_of_year,
           strftime(calendar_date, '%B') AS month_name,
           strftime(calendar_date, '%b') AS month_name_short,
           strftime(calendar_date, '%A') AS day_name,
           strftime(calendar_date, '%a') AS day_name_short,
           CAST(strftime(calendar_date, '%Y%m') AS INTEGER) AS year_month_key,
           CAST(strftime(calendar_date, '%Y') AS INTEGER) AS year_key,
           year(calendar_date) || '-Q' || quarter(calendar_date)
               AS fiscal_quarter_label,
           dayofweek(calendar_date) IN (0, 6) AS is_weekend,
           calendar_date IN (SELECT calendar_date FROM days) AS is_trading_day,
           calendar_date = DATE '{AS_OF}' AS is_today,
           year(calendar_date) = year(DATE '{AS_OF}') AS is_current_year,
           strftime(calendar_date, '%Y%m') = strftime(DATE '{AS_OF}', '%Y%m')
               AS is_current_month
    FROM (SELECT CAST(d AS DATE) AS calendar_date
          FROM range(DATE '{CALENDAR[0]}', DATE '{CALENDAR[1]}', INTERVAL 1 DAY) t(d))"""


def _freshness(table: str, warn_hours: int, error_hours: int) -> str:
    return f"""
        SELECT max_loaded_at, age_hours,
               CASE WHEN age_hours > {error_hours} THEN 'error'
                    WHEN age_hours > {warn_hours} THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max_loaded_at,
                     date_diff('second', max_loaded_at, TIMESTAMP '{NOW}') / 3600.0
                         AS age_hours
              FROM (SELECT max(CAST(extracted_at AS TIMESTAMP)) AS max_loaded_at
                    FROM {table}))"""


def _count(name: str, source: str, rule: str = "true") -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) FILTER ({rule}) AS violations, "
        f"count(*) FILTER ({rule}) = 0 AS passed FROM {source}"
    )


BAD_OHLC = """open_price <= 0 OR high_price <= 0 OR low_price <= 0 OR close_price <= 0
    OR high_price < open_price OR high_price < close_price OR high_price < low_price
    OR low_price > open_price OR low_price > close_price"""
ODD_VOLATILITY = "volatility_20d_annualized < 0.1 OR volatility_20d_annualized > 500"
SHORT_HISTORY = f"""
    SELECT ticker, count(*) AS trading_day_count FROM INPUT
    GROUP BY ticker HAVING count(*) < {MIN_ROWS}"""

ALL_SIGNALS = """
        SELECT price_id, ticker, trading_date, close_price, open_price, volume,
               prev_close_price, daily_return_pct, log_return_pct, overnight_gap_pct,
               sma_7d, sma_30d, sma_90d, sma_200d, avg_volume_20d, avg_volume_90d,
               relative_volume_20d, high_52w, low_52w, price_position_52w,
               volatility_20d_annualized, volatility_60d_annualized,
               avg_intraday_range_pct_20d FROM signals"""

FINAL: dict[str, str] = {
    "stg_stock_prices": "SELECT * FROM dirty_stg",
    "stg_company_info": "SELECT * FROM companies",
    "stg_economic_indicators": "SELECT * FROM indicators",
    "int_daily_returns": """
        SELECT price_id, ticker, trading_date, close_price, open_price, volume,
               prev_close_price, daily_return_pct, log_return_pct, overnight_gap_pct
        FROM returns""",
    "int_moving_averages": """
        SELECT price_id, ticker, trading_date, close_price, volume, sma_7d, sma_30d,
               sma_90d, sma_200d, avg_volume_20d, avg_volume_90d, relative_volume_20d,
               high_52w, low_52w, price_position_52w FROM signals""",
    "int_volatility": """
        SELECT price_id, ticker, trading_date, close_price, daily_return_pct,
               log_return_pct, volatility_20d_annualized, volatility_60d_annualized,
               avg_intraday_range_pct_20d FROM signals""",
    "sliced_signals": ALL_SIGNALS,
    "incremental_signals": ALL_SIGNALS,
    "pivot_indicators": "SELECT * FROM wide",
    "int_macro_context": "SELECT * FROM macro",
    "asof_macro_context": f"""
        SELECT *, round(treasury_yield_10y - breakeven_inflation_10y, 4)
                  AS real_yield_10y
        FROM (SELECT calendar_date, {INDICATOR_ROW} FROM days)""",
    "enrich_from_seed": """
        SELECT c.ticker, c.company_name,
               CASE WHEN c.sector = 'Unknown' THEN n_name ELSE c.sector END AS sector,
               c.industry, c.market_cap, c.currency, c.exchange, c.country
        FROM companies c JOIN supplier ON s_name = c.ticker
        JOIN nation ON n_nationkey = s_nationkey""",
    "dim_company": "SELECT * FROM dim_company_t",
    "date_spine": """
        SELECT CAST(d AS DATE) AS calendar_date
        FROM (SELECT unnest(generate_series(min(trading_date), max(trading_date),
                                            INTERVAL 1 DAY)) AS d FROM stg)""",
    "dim_date": DIM_DATE,
    "fct_daily_trading": "SELECT * FROM fact",
    "as_of_date": "SELECT max(trading_date) AS as_of_date FROM stg",
    "tickers": "SELECT DISTINCT ticker FROM stg ORDER BY ticker",
    "latest_snapshot": "SELECT * FROM snapshot",
    "latest_per_ticker": """
        SELECT ticker, max(trading_date) AS trading_date,
               max_by(close_price, trading_date) AS close_price
        FROM stg GROUP BY ticker""",
    "price_history": "SELECT * FROM history",
    "ticker_history": f"SELECT * FROM history WHERE ticker = '{TICKER}'",
    "macro_indicators": "SELECT * FROM macro_rows",
    "macro_latest": "SELECT * FROM macro_rows ORDER BY trading_date DESC LIMIT 1",
    "macro_vs_stocks": "SELECT * FROM versus",
    "regime_performance": """
        SELECT rate_regime, round(avg(daily_return_pct), 4) AS avg_daily_return,
               round(stddev_samp(daily_return_pct), 4) AS std_daily_return,
               count(*) AS observations
        FROM versus GROUP BY rate_regime""",
    "performance_52w": "SELECT * FROM perf",
    "best_performer": """
        SELECT ticker, company_name, return_52w_pct FROM perf
        ORDER BY return_52w_pct DESC NULLS LAST, ticker LIMIT 1""",
    "worst_performer": """
        SELECT ticker, company_name, return_52w_pct FROM perf
        ORDER BY return_52w_pct ASC NULLS LAST, ticker LIMIT 1""",
    "monthly_returns": "SELECT * FROM months",
    "ticker_monthly": f"SELECT * FROM months WHERE ticker = '{TICKER}'",
    "sector_summary": """
        SELECT sector, count(DISTINCT ticker) AS num_stocks,
               round({exact_avg:daily_return_pct} / 100, 6) AS avg_daily_return_pct,
               round({exact_avg:volatility_20d_annualized} / 100, 4)
                   AS avg_volatility_20d_pct,
               round(avg(volume), 0) AS avg_volume,
               round(avg(close_price / nullif(sma_200d, 0) - 1), 4)
                   AS avg_pct_above_200sma
        FROM latest GROUP BY sector""",
    "market_summary": """
        SELECT count(*) AS num_stocks, round(avg(daily_return_pct), 3)
                   AS avg_daily_return,
               count(*) FILTER (daily_return_pct > 0) AS gainers,
               count(*) FILTER (daily_return_pct < 0) AS losers,
               max(as_of_date) AS as_of_date
        FROM snapshot""",
    "ticker_stats": """
        SELECT ticker, round(min(close_price), 2) AS low_52w,
               round(max(close_price), 2) AS high_52w,
               round({exact_avg:close_price}, 2) AS avg_close,
               round(avg(volume), 0) AS avg_volume,
               round(avg(daily_return_pct / 100), 4) AS avg_daily_return,
               round(stddev_samp(daily_return_pct / 100), 4) AS std_daily_return,
               count(*) AS trading_days
        FROM trailing_year GROUP BY ticker""",
    "stock_info": """
        SELECT ticker, company_name, sector, industry, market_cap_category, exchange
        FROM snapshot WHERE ticker = (SELECT t FROM first_ticker)""",
    "daily_movers": "SELECT * FROM movers",
    "briefing_52w": "SELECT * FROM perf_brief",
    "briefing_macro": """
        SELECT round(fed_funds_rate, 2) AS fed_funds_rate,
               round(treasury_yield_10y, 2) AS treasury_yield_10y,
               round(real_yield_10y, 2) AS real_yield_10y,
               round(unemployment_rate, 1) AS unemployment_rate,
               round(breakeven_inflation_10y, 2) AS breakeven_inflation_10y,
               round(gdp_growth_rate, 1) AS gdp_growth_rate
        FROM latest WHERE ticker = (SELECT t FROM first_ticker)""",
    "briefing_sectors": """
        SELECT sector, round({exact_avg:daily_return_pct}, 3) AS avg_return,
               round({exact_avg:volatility_20d_annualized}, 1) AS avg_vol
        FROM latest GROUP BY sector""",
    "market_facts": """
        SELECT (SELECT count(*) FROM movers WHERE daily_return_pct > 0) AS gainers,
               (SELECT count(*) FROM movers WHERE daily_return_pct < 0) AS losers,
               (SELECT ticker FROM movers ORDER BY daily_return_pct DESC, ticker LIMIT 1)
                   AS top_gainer,
               (SELECT max(daily_return_pct) FROM movers) AS top_gainer_pct,
               (SELECT ticker FROM movers ORDER BY daily_return_pct, ticker LIMIT 1)
                   AS top_loser,
               (SELECT min(daily_return_pct) FROM movers) AS top_loser_pct,
               (SELECT ticker FROM perf_brief ORDER BY return_52w_pct DESC, ticker
                LIMIT 1) AS best_52w,
               (SELECT max(return_52w_pct) FROM perf_brief) AS best_52w_pct,
               (SELECT ticker FROM perf_brief ORDER BY return_52w_pct, ticker LIMIT 1)
                   AS worst_52w,
               (SELECT min(return_52w_pct) FROM perf_brief) AS worst_52w_pct""",
    "cagr_by_ticker": """
        SELECT ticker, a AS start_price, z AS end_price, round(years, 4) AS years,
               round(pow(z / nullif(a, 0), 1.0::DOUBLE / nullif(years, 0)) - 1, 6)
                   AS cagr
        FROM (SELECT ticker, min_by(close_price, trading_date) AS a,
                     max_by(close_price, trading_date) AS z,
                     CAST(max(trading_date) - min(trading_date) AS DOUBLE) / 365.25
                         AS years
              FROM stg GROUP BY ticker)""",
    "sharpe_by_ticker": """
        SELECT ticker, round(m, 4) AS annual_return_pct, round(rf, 4) AS risk_free_pct,
               round(v, 4) AS annual_volatility_pct,
               round((m - rf) / nullif(v, 0), 4) AS sharpe_ratio
        FROM (SELECT ticker, {exact_avg:log_return_pct} * 252 AS m,
                     avg(treasury_yield_10y) AS rf,
                     stddev_samp(log_return_pct) * sqrt(252) AS v
              FROM fact GROUP BY ticker)""",
    "drawdown_series": "SELECT * FROM falls",
    "sliced_drawdown": "SELECT * FROM falls",
    "max_drawdown_by_ticker": """
        SELECT ticker, min(drawdown) AS max_drawdown FROM falls GROUP BY ticker""",
    "concat_by_name": f"""
        SELECT date, ticker, open, high, low, close,
               CASE WHEN date >= DATE '{HISTORY[0]}' THEN volume END AS volume
        FROM raw_prices""",
    "normalized_and_stamped": f"""
        SELECT CAST(o_orderdate AS DATE) AS observation_date, o_totalprice AS value,
               o_orderkey AS order_key, 'TOTAL' AS series_id, {AT} AS extracted_at
        FROM orders""",
    "restrict_history": f"""
        SELECT * FROM raw_prices
        WHERE date >= DATE '{HISTORY[0]}' AND date < DATE '{HISTORY[1]}'""",
    "restrict_macro_history": f"""
        SELECT * FROM raw_indicators
        WHERE observation_date BETWEEN DATE '{HISTORY[0]}' AND DATE '{HISTORY[1]}'""",
    "infer_frequency": """
        SELECT series_id, g AS median_gap_days,
               CASE WHEN g IS NULL THEN 'unknown' WHEN g <= 1 THEN 'daily'
                    WHEN g <= 8 THEN 'weekly' WHEN g <= 35 THEN 'monthly'
                    WHEN g <= 100 THEN 'quarterly' ELSE 'annual' END AS frequency
        FROM (SELECT series_id, CAST(floor(median(gap)) AS INTEGER) AS g
              FROM (SELECT series_id, observation_date - lag(observation_date) OVER (
                        PARTITION BY series_id ORDER BY observation_date) AS gap
                    FROM raw_indicators) GROUP BY series_id)""",
    "extract_stats": """
        SELECT series_id, count(*) AS row_count, min(observation_date) AS first_date,
               max(observation_date) AS last_date
        FROM raw_indicators GROUP BY series_id""",
    "extract_stats_prices": """
        SELECT ticker, count(*) AS row_count, min(date) AS first_date,
               max(date) AS last_date
        FROM raw_prices GROUP BY ticker""",
    "load_summary": """
        SELECT 'raw_stock_prices' AS table_name, count(*) AS row_count,
               8 AS column_count FROM raw_prices
        UNION ALL SELECT 'raw_company_info', count(*), 10 FROM raw_companies
        UNION ALL SELECT 'raw_economic_indicators', count(*), 6 FROM raw_indicators""",
    "valid_ohlc": f"""
        SELECT price_id, ticker, trading_date, open_price, high_price, low_price,
               close_price FROM dirty_stg WHERE {BAD_OHLC}""",
    "positive_volume": """
        SELECT ticker, date, volume FROM dirty_prices WHERE volume <= 0""",
    "reasonable_daily_return": """
        SELECT price_id, ticker, trading_date, daily_return_pct FROM returns
        WHERE abs(daily_return_pct) > 75""",
    "reasonable_volatility": f"""
        SELECT price_id, ticker, trading_date, volatility_20d_annualized FROM signals
        WHERE {ODD_VOLATILITY}""",
    "no_large_date_gaps": """
        SELECT price_id, ticker, trading_date, prev_trading_date,
               CAST(gap_days AS INTEGER) AS gap_days
        FROM gaps WHERE gap_days > 7""",
    "sufficient_history": SHORT_HISTORY.replace("INPUT", "stg"),
    "tickers_in_dim": """
        SELECT DISTINCT ticker FROM stg
        WHERE ticker NOT IN (SELECT ticker FROM kept_companies)""",
    "dates_in_dim": """
        SELECT calendar_date AS trading_date FROM days
        WHERE calendar_date NOT IN (SELECT calendar_date FROM short_dates)""",
    "not_null": """
        SELECT * EXCLUDE (extracted_at) FROM dirty_prices WHERE close IS NULL""",
    "unique": """
        SELECT price_id AS unique_field, count(*) AS n_records FROM dirty_stg
        GROUP BY price_id HAVING count(*) > 1""",
    "freshness": _freshness("raw_prices", 25, 49),
    "freshness_macro": _freshness("raw_indicators", 40 * 24, 60 * 24),
    "check_schema": """
        SELECT 'date' AS column_name, 'timestamp_ntz' AS declared_type,
               'date' AS actual_type,
               count(*) FILTER (date IS NOT NULL
                                AND TRY_CAST(date AS TIMESTAMP) IS NULL) AS misfits
        FROM raw_prices""",
    "quality_report": " UNION ALL ".join(
        [
            _count("positive_volume", "dirty_prices", "volume <= 0"),
            *[
                _count(f"raw_not_null_{c}", "dirty_prices", f"{c} IS NULL")
                for c in ("open", "high", "low", "close")
            ],
            _count("valid_ohlc", "dirty_stg", BAD_OHLC),
            _count(
                "reasonable_daily_return", "dirty_returns", "abs(daily_return_pct) > 75"
            ),
            _count("reasonable_volatility", "dirty_signals", ODD_VOLATILITY),
            _count("no_large_date_gaps", "dirty_gaps", "gap_days > 7"),
            *[
                _count(f"not_null_{c}", "dirty_stg", f"{c} IS NULL")
                for c in ("price_id", "ticker", "trading_date", "close_price")
            ],
            _count("sufficient_history", f"({SHORT_HISTORY.replace('INPUT', 'dirty_stg')})"),
            _count(
                "unique_price_id",
                "(SELECT price_id FROM dirty_stg GROUP BY 1 HAVING count(*) > 1)",
            ),
            _count(
                "tickers_in_dim",
                "(SELECT DISTINCT ticker FROM dirty_stg)",
                "ticker NOT IN (SELECT ticker FROM kept_companies)",
            ),
            _count(
                "dates_in_dim",
                "(SELECT DISTINCT trading_date FROM dirty_stg)",
                "trading_date NOT IN (SELECT calendar_date FROM short_dates)",
            ),
        ]
    ),
}


# The step that stands for each table of the declared tests.
TABLES = {
    "raw_stock_prices": "raw_prices",
    "raw_company_info": "raw_companies",
    "raw_economic_indicators": "raw_indicators",
    "stg_stock_prices": "stg",
    "stg_company_info": "companies",
    "stg_economic_indicators": "indicators",
    "int_daily_returns": "returns",
    "int_moving_averages": "signals",
    "int_macro_context": "macro",
    "int_volatility": "signals",
    "fct_daily_trading": "fact",
    "dim_company": "dim_company_t",
    "dim_date": "calendar",
    "sp500_companies": "seed",
}
FINAL["data_tests"] = " UNION ALL ".join(
    [
        *[
            _count(f"not_null_{column}_{table}", TABLES[table], f"{column} IS NULL")
            for table, columns in NOT_NULL.items()
            for column in columns
        ],
        *[
            _count(
                f"unique_{column}_{table}",
                f"(SELECT {column} FROM {TABLES[table]} WHERE {column} IS NOT NULL "
                f"GROUP BY 1 HAVING count(*) > 1)",
            )
            for table, columns in UNIQUE.items()
            for column in columns
        ],
        _count("positive_volume", "raw_prices", "volume <= 0"),
        _count("valid_ohlc", "stg", BAD_OHLC),
        _count("reasonable_daily_return", "returns", "abs(daily_return_pct) > 75"),
        _count("reasonable_volatility", "signals", ODD_VOLATILITY),
        _count("no_large_date_gaps", "gaps", "gap_days > 7"),
        _count("sufficient_history", f"({SHORT_HISTORY.replace('INPUT', 'stg')})"),
        _count(
            "fct_tickers_in_dim_company",
            "(SELECT DISTINCT ticker FROM fact)",
            "ticker NOT IN (SELECT ticker FROM companies)",
        ),
        _count(
            "fct_dates_in_dim_date",
            "(SELECT DISTINCT trading_date FROM fact)",
            "trading_date NOT IN (SELECT calendar_date FROM calendar)",
        ),
    ]
)


def _expand(sql: str) -> str:
    """Fill in the templates."""
    return re.sub(
        r"\{(\w+):(\w+)\}", lambda m: TEMPLATES[m[1]].replace("INPUT", m[2]), sql
    )


def _steps_in(sql: str, found: dict[str, str]) -> dict[str, str]:
    """The steps a query names, each after the steps it names itself."""
    for name in re.findall(r"\w+", re.sub(r"'[^']*'", "", sql)):
        if name in STEPS and name not in found:
            body = _expand(STEPS[name])
            if body != sql:
                _steps_in(body, found)
                found[name] = body
    return found


def oracle_sql() -> dict[str, str]:
    queries = {}
    for name, text in FINAL.items():
        sql = _expand(text)
        steps = _steps_in(sql, {})
        parts = [f"{step} AS MATERIALIZED ({body})" for step, body in steps.items()]
        queries[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql
    return queries
