"""The declared data tests of all tables, as one report.

A test passes if it finds no violation.  The report states; it does not raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tapeline.operators import quality

# Which columns of which table must be filled, and unique.
NOT_NULL = {
    "raw_stock_prices": [
        "date", "ticker", "open", "high", "low", "close", "volume", "extracted_at",
    ],
    "raw_company_info": ["ticker", "extracted_at"],
    "raw_economic_indicators": ["series_id", "observation_date", "extracted_at"],
    "stg_stock_prices": ["price_id", "ticker", "trading_date"],
    "stg_company_info": ["ticker"],
    "stg_economic_indicators": ["series_id", "observation_date"],
    "int_daily_returns": ["price_id", "ticker", "trading_date"],
    "int_moving_averages": ["price_id"],
    "int_macro_context": ["calendar_date"],
    "int_volatility": ["price_id"],
    "fct_daily_trading": ["price_id", "ticker", "trading_date", "close_price"],
    "dim_company": ["company_key", "ticker"],
    "dim_date": ["calendar_date"],
    "sp500_companies": ["ticker", "company_name", "sector"],
}
UNIQUE = {
    "raw_company_info": ["ticker"],
    "stg_stock_prices": ["price_id"],
    "stg_company_info": ["ticker"],
    "int_daily_returns": ["price_id"],
    "int_moving_averages": ["price_id"],
    "int_macro_context": ["calendar_date"],
    "int_volatility": ["price_id"],
    "fct_daily_trading": ["price_id"],
    "dim_company": ["company_key", "ticker"],
    "dim_date": ["calendar_date"],
    "sp500_companies": ["ticker"],
}


def row_rules(table: str) -> dict[str, Column]:
    """The tests that look at one row at a time, by name."""
    own = {
        "raw_stock_prices": {"positive_volume": quality.no_volume},
        "stg_stock_prices": {"valid_ohlc": quality.breaks_ohlc},
        "int_daily_returns": {"reasonable_daily_return": quality.large_return},
        "int_volatility": {"reasonable_volatility": quality.odd_volatility},
    }
    declared = {
        f"{name}_{table}": rule
        for name, rule in quality.nulls(*NOT_NULL.get(table, [])).items()
    }
    return declared | {name: rule() for name, rule in own.get(table, {}).items()}


def data_tests(tables: dict[str, DataFrame], min_rows: int = 200) -> DataFrame:
    """Violations per test over the given tables; tests of others are left out.

    All row tests of a table share a pass; a uniqueness test groups by its
    column alone, so repeats collapse before they are shuffled.
    """
    counts = []
    for name, df in tables.items():
        rules = row_rules(name)
        if rules:
            counts.append(quality.count_breaks(df, quality.count_rules(rules)))
        for column in UNIQUE.get(name, []):
            repeats = quality.unique(df, column)
            counts.append(quality.count_violations(f"unique_{column}_{name}", repeats))

    def across(test: str, check, *names: str, **options) -> None:
        if all(n in tables for n in names):
            found = check(*[tables[n] for n in names], **options)
            counts.append(quality.count_violations(test, found))

    across("no_large_date_gaps", quality.no_large_date_gaps, "stg_stock_prices")
    across(
        "sufficient_history", quality.sufficient_history, "stg_stock_prices",
        rows=min_rows,
    )
    across(
        "fct_tickers_in_dim_company", quality.tickers_in_dim,
        "fct_daily_trading", "stg_company_info",
    )
    across(
        "fct_dates_in_dim_date", quality.dates_in_dim, "fct_daily_trading", "dim_date"
    )
    return quality.quality_report(counts)
