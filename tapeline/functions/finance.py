"""Financial formulas as column templates."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tapeline.functions.numbers import ratio, rnd

#: Trading days per year (fixed value).
TRADING_DAYS = 252


def pct_change(current: Column, prior: Column) -> Column:
    """Change against a prior value in percent, four decimals."""
    current, prior = current.cast("double"), prior.cast("double")
    return rnd(ratio(current - prior, prior) * 100, 4)


def log_return(current: Column, prior: Column) -> Column:
    """Logarithmic return in percent; NULL unless the price ratio is positive."""
    growth = ratio(current, prior)
    return rnd(F.when(growth > 0, F.ln(growth)) * 100, 4)


def cagr(start: Column, end: Column, years: Column) -> Column:
    """Compound annual growth rate as a fraction; NULL when start or years is 0."""
    growth = ratio(end.cast("double"), start.cast("double"))
    return F.pow(growth, ratio(F.lit(1.0), years.cast("double"))) - 1


def sharpe(avg_return: Column, risk_free: Column, volatility: Column) -> Column:
    """Excess return per unit of volatility; NULL when volatility is 0."""
    return ratio(avg_return - risk_free, volatility)


def fall_from_peak(price: Column, peak: Column) -> Column:
    """Distance below a running peak: 0 at the peak, -1 at a total loss."""
    return rnd(ratio(price, peak) - 1, 4)


def drawdown(price: Column, ticker: Column, date: Column) -> Column:
    """Running drawdown per row, against the highest price of the ticker so far."""
    so_far = (
        Window.partitionBy(ticker)
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return fall_from_peak(price, F.max(price).over(so_far))
