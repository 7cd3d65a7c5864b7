"""Cutting long series so that no window holds an unbounded one.

A daily series has one row per ticker and day: at most 366 rows a year, however
many trades lie behind it, so a window per ticker is small.  Input that breaks
this rule (intraday rows, repeated loads) can put most rows into one ticker.
``cut_long_series`` splits such tickers into slices along the date and copies
into each slice the rows a row frame reaches back to; the results are the same
as on the whole series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows a row frame of the signals reaches back: 251 for the 52-week range.
REACH = 252
#: Rows per slice; a slice of this size is a few tens of megabytes.
SLICE_ROWS = 500_000


def cut_long_series(df: DataFrame, reach: int, rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``slice_no`` and ``is_lead``; lead rows only feed frames and are
    dropped after the windows ran.  Short series stay whole, in slice 0."""
    if reach >= rows:
        raise ValueError("a slice must be longer than the reach of the frames")
    # One row per ticker and day: bounded by the calendar, so windows are small.
    ticker = Window.partitionBy("ticker")
    before = ticker.orderBy("trading_date").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        df.groupBy("ticker", "trading_date")
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "first": F.coalesce(F.sum("n").over(before), F.lit(0)),
                "total": F.sum("n").over(ticker),
            }
        )
        .filter(F.col("total") > rows)
    )
    # A later slice starts behind this day.  It needs the day if it starts less
    # than ``reach`` rows behind it; with slices longer than the reach that is
    # one slice, or two around a boundary.
    end = F.col("first") + F.col("n")
    own = F.floor(F.col("first") / rows)
    low = F.greatest(own + 1, F.floor(end / rows))
    high = F.floor((end + reach - 1) / rows)
    leads = F.when(high >= low, F.sequence(low, high)).otherwise(
        F.array().cast("array<bigint>")
    )
    places = days.select(
        "ticker", "trading_date", own.alias("own"),
        F.concat(F.array(own), leads).alias("places"),
    )
    # Only days of long series are in ``places``; Spark broadcasts it if it
    # turns out small, and otherwise joins by ticker and day, which no long
    # series can dominate.
    return (
        df.join(places, ["ticker", "trading_date"], "left")
        .withColumn(
            "slice_no", F.expr("explode(coalesce(places, array(bigint(0))))")
        )
        .withColumn("is_lead", F.expr("slice_no <> coalesce(own, 0)"))
        .drop("own", "places")
    )


def per_series(
    df: DataFrame,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    slice_rows: int | None,
    reach: int = REACH,
    keys: Sequence[str] = ("ticker",),
) -> DataFrame:
    """Run window columns per ticker or, with ``slice_rows``, per slice of one.

    ``compute`` gets the rows and the columns to partition its windows by: ``keys``, which
    may name columns that follow from the ticker beside it.
    """
    if slice_rows is None:
        return compute(df, [*keys])
    slices = cut_long_series(df, reach, slice_rows)
    rows = compute(slices, [*keys, "slice_no"])
    return rows.filter(~F.col("is_lead")).drop("slice_no", "is_lead")
