"""Small hand-made inputs."""

import datetime as dt

from tapeline.sources.schemas import COMPANIES, INDICATORS, PRICES

LOADED = "2024-01-05"


def day(n, start=dt.date(2024, 1, 1)):
    return start + dt.timedelta(days=n)


def bars(spark, closes, ticker="AAA", volume=100, start=dt.date(2024, 1, 1)):
    """Daily bars with the given closes; open, high and low around them."""
    rows = [
        (
            dt.datetime.combine(day(i, start), dt.time()), ticker,
            c, None if c is None else c + 1, None if c is None else c - 1, c,
            volume + i, LOADED,
        )
        for i, c in enumerate(closes)
    ]
    return spark.createDataFrame(rows, PRICES)


def companies(spark, *rows):
    """Rows of (ticker, sector, industry, market_cap)."""
    full = [
        (t, f"{t} Inc.", sector, industry, cap, None, "X", None, None, LOADED)
        for t, sector, industry, cap in rows
    ]
    return spark.createDataFrame(full, COMPANIES)


def observations(spark, *rows):
    """Rows of (series, date, value)."""
    full = [(d, v, s, s.title(), "daily", LOADED) for s, d, v in rows]
    return spark.createDataFrame(full, INDICATORS)


def by(df, *key):
    """Rows as dicts under their key."""
    return {tuple(r[k] for k in key): r.asDict() for r in df.collect()}


def column(df, name, order="trading_date"):
    return [r[name] for r in df.orderBy(order).select(name).collect()]
