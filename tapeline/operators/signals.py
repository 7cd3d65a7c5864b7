"""Returns, moving averages, volume signals, 52-week range and volatility.

All of them come out of one pass per ticker: one exchange, one sort.  Sliding
averages are differences of running totals, which cost the same for a frame of
200 rows as for one of 7 and, on whole numbers, are exact.  The 52-week range is put
together from shorter stretches, all of them behind the row, so no window needs the
bars in another order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.finance import TRADING_DAYS, log_return, pct_change
from tapeline.functions.labels import surrogate_key
from tapeline.functions.numbers import MONEY, SCALE, ratio, rnd, rnd_sql, ticks
from tapeline.operators.series import REACH, per_series

# The columns of the three steps.
RETURNS = [
    "price_id", "ticker", "trading_date", "close_price", "open_price", "volume",
    "prev_close_price", "daily_return_pct", "log_return_pct", "overnight_gap_pct",
]
AVERAGES = [
    "price_id", "ticker", "trading_date", "close_price", "volume",
    "sma_7d", "sma_30d", "sma_90d", "sma_200d",
    "avg_volume_20d", "avg_volume_90d", "relative_volume_20d",
    "high_52w", "low_52w", "price_position_52w",
]
VOLATILITY = [
    "price_id", "ticker", "trading_date", "close_price",
    "daily_return_pct", "log_return_pct",
    "volatility_20d_annualized", "volatility_60d_annualized",
    "avg_intraday_range_pct_20d",
]

#: All of the above, each once.
SIGNALS = list(dict.fromkeys(RETURNS + AVERAGES + VOLATILITY))


def daily_signals(stg: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Every per-ticker column of the fact table, one row per staged bar.

    Frames count rows, not days, and start with the first row of a ticker.
    Columns a query does not read are pruned with their window expressions.
    Give ``slice_rows`` for input not known to be one row per ticker and day:
    longer series are then cut into slices of that many rows.
    """
    return with_signals(stg, slice_rows).select(SIGNALS)


def latest_signals(stg: DataFrame) -> DataFrame:
    """The signals of the last bar of each ticker, from as many bars as they
    reach back to.  Spark drops older bars before the exchange, so what moves
    does not grow with the years of history."""
    back = F.expr("row_number() OVER (PARTITION BY ticker ORDER BY trading_date DESC)")
    tail = stg.withColumn("bars_back", back).filter(F.col("bars_back") <= REACH + 1)
    return with_signals(tail).filter("bars_back = 1").select(SIGNALS)


def trailing_bars(stg: DataFrame, days: int = 365, reach: int = REACH) -> DataFrame:
    """The bars of the last ``days`` days before the newest bar of all, and per ticker the
    last ``reach`` bars before them, told apart by ``is_wanted``.

    Of the latter each task keeps as many per ticker before it shuffles."""
    since = stg.agg(F.date_sub(F.max("trading_date"), days).alias("since")).scalar()
    back = f"row_number() OVER (PARTITION BY ticker ORDER BY {DESCENDING})"
    before = (
        stg.filter(F.col("trading_date") < since)
        .withColumn("bars_back", F.expr(back))
        .filter(F.col("bars_back") <= reach)
        .drop("bars_back")
    )
    wanted = stg.filter(F.col("trading_date") >= since)
    return wanted.withColumn("is_wanted", F.lit(True)).unionByName(
        before.withColumn("is_wanted", F.lit(False))
    )


def trailing_signals(
    stg: DataFrame, days: int = 365, reach: int = REACH, slice_rows: int | None = None
) -> DataFrame:
    """The signals of the bars of the last ``days`` days before the newest bar of all.

    The year is cut below the windows, with as many bars before it as the frames of the
    columns in use reach back over: what moves and what the windows see does not grow
    with the years.
    """
    rows = with_signals(trailing_bars(stg, days, reach), slice_rows)
    return rows.filter("is_wanted").select(SIGNALS)


def with_signals(
    stg: DataFrame, slice_rows: int | None = None, keys: Sequence[str] = ("ticker",)
) -> DataFrame:
    """The staged bars with the signals beside their own columns.  Bars that are laid out
    by columns which follow from the ticker are not moved if ``keys`` names these too."""
    return per_series(stg, _signals, slice_rows, keys=keys).drop(*_HELPERS)


#: Bars of one date follow by their own figures, so that repeated loads give the same
#: results in any layout.
ORDER = ["trading_date", "close_price", "open_price", "high_price", "low_price", "volume"]
DESCENDING = ", ".join(f"{c} DESC" for c in ORDER)


def _signals(stg: DataFrame, keys: list[str]) -> DataFrame:
    series = f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(ORDER)}"
    # All windows look back in one order, so one sort serves them.  Each step works out
    # what it can: in one step the code would be too long for the JVM to compile.
    rows = _with_returns(stg.drop("price_id"), series)
    rows = _with_averages(_with_volumes(rows, series), series)
    rows = _with_volatility(rows, series)
    # The key is a hash of two columns at hand: made again after the exchange
    # rather than carried through it.
    return rows.withColumn("price_id", surrogate_key(F.col("ticker"), F.col("trading_date")))


def _with_returns(stg: DataFrame, series: str) -> DataFrame:
    close, prev = F.col("close_price"), F.col("prev_close_price")
    day_range = ratio(F.col("high_price") - F.col("low_price"), close)
    # What a window is given is worked out before the exchange: here only columns that are
    # there anyway, so that no others are moved.
    windows = {
        "row_no": f"row_number() OVER ({series})",
        "prev_close_price": f"lag(close_price) OVER ({series})",
        **_running(VOLUME_TOTALS, series),
        **_lags(0, series),
    }
    return (
        _add(stg, windows)
        .withColumns(
            {
                "daily_return_pct": pct_change(close, prev),
                "log_return_pct": log_return(close, prev),
                "overnight_gap_pct": pct_change(F.col("open_price"), prev),
            }
        )
        .withColumns(
            {
                "close_exact": close.try_cast(MONEY),
                "log_ticks": ticks(F.col("log_return_pct")),
                "range_ticks": ticks(rnd(day_range * 100, 4)),
            }
        )
        .selectExpr("*", *_extremes(0))
    )


def _add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])


#: Running totals of values that count as 0 where they are missing: by the step that reads
#: them.
VOLUME_TOTALS = {"volume_sum": "sum(volume)"}
CLOSE_TOTALS = {"close_sum": "sum(coalesce(close_exact, 0))"}
RETURN_TOTALS = {
    "log_sum": "sum(coalesce(log_ticks, 0))",
    "log_sq_sum": "sum(coalesce(log_ticks * log_ticks, 0))",
    "log_n": "count(log_ticks)",
    "range_sum": "sum(coalesce(range_ticks, 0))",
    "range_n": "count(range_ticks)",
}
#: How many rows back each total is needed.
BACK = {
    "close_sum": (7, 30, 90, 200),
    "volume_sum": (1, 20, 21, 90),
    "log_sum": (20, 60),
    "log_sq_sum": (20, 60),
    "log_n": (20, 60),
    "range_sum": (20,),
    "range_n": (20,),
}
SO_FAR = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _running(totals: dict[str, str], series: str) -> dict[str, str]:
    return {name: f"{total} OVER ({series} {SO_FAR})" for name, total in totals.items()}


def _earlier_totals(totals: dict[str, str], series: str) -> dict[str, str]:
    """Totals as they stood some rows ago, 0 before the start."""
    return {
        f"{name}_{back}": f"lag({name}, {back}, 0) OVER ({series})"
        for name in totals
        for back in BACK[name]
    }


#: The 52-week range in steps: the extremes of 6 rows, of 6 such stretches, which are 36
#: rows, and of 7 of those, which are 252.  A step looks at a few earlier rows, however
#: long the frame is.
STEPS = (6, 6, 7)
assert math.prod(STEPS) == TRADING_DAYS
#: Ends of the range, and the function that picks each.
ENDS = {"high": "greatest", "low": "least"}


def _stretch(end: str, step: int) -> str:
    """The column with an end of the rows that the steps before this one cover."""
    if step == 0:
        return "close_price"
    return f"{end}_{'52w' if step == len(STEPS) else math.prod(STEPS[:step])}"


def _earlier(step: int) -> list[int]:
    """How many rows back the stretches of a step end, beside the one at hand."""
    return [i * math.prod(STEPS[:step]) for i in range(1, STEPS[step])]


def _lags(step: int, series: str) -> dict[str, str]:
    """The stretches before each row, NULL before the start."""
    return {
        f"{name}_{back}_back": f"lag({name}, {back}) OVER ({series})"
        for name in dict.fromkeys(_stretch(end, step) for end in ENDS)
        for back in _earlier(step)
    }


def _extremes(step: int) -> list[str]:
    """The ends of the rows that this step covers; missing stretches do not count."""
    found = []
    for end, pick in ENDS.items():
        name = _stretch(end, step)
        parts = [name, *[f"{name}_{back}_back" for back in _earlier(step)]]
        found.append(f"{pick}({', '.join(parts)}) AS {_stretch(end, step + 1)}")
    return found


_HELPERS = [
    "row_no", "close_exact", "wide_at", "log_ticks", "range_ticks", *BACK,
    *[f"{name}_{back}" for name, rows_back in BACK.items() for back in rows_back],
    *[_stretch(end, step) for end in ENDS for step in range(1, len(STEPS))],
    *[name for step in range(len(STEPS)) for name in _lags(step, "")],
]


def _trailing(name: str, length: int) -> str:
    return f"({name} - {name}_{length})"


def _with_volumes(rows: DataFrame, series: str) -> DataFrame:
    """Means of volumes."""

    def avg_volume(length: int) -> str:
        return rnd_sql(f"{_trailing('volume_sum', length)} / least(row_no, {length})", 0)

    windows = {
        **_earlier_totals(VOLUME_TOTALS, series),
        **_running(CLOSE_TOTALS, series),
        **_lags(1, series),
    }
    prior = "try_divide(volume_sum_1 - volume_sum_21, least(row_no - 1, 20))"
    return _add(
        _add(rows, windows),
        {
            "avg_volume_20d": avg_volume(20),
            "avg_volume_90d": avg_volume(90),
            "relative_volume_20d": rnd_sql(f"try_divide(volume, {prior})", 2),
        },
    ).selectExpr("*", *_extremes(1))


def _with_averages(rows: DataFrame, series: str) -> DataFrame:
    """Means of closes and the 52-week range.  A frame with a close that fits no decimal
    has no mean; ``wide_at`` is the last such row so far."""

    def sma(length: int) -> str:
        mean = f"double({_trailing('close_sum', length)}) / least(row_no, {length})"
        # within the rounding, so that the mean is worked out once
        return rnd_sql(f"IF(row_no - wide_at < {length}, NULL, {mean})", 4)

    windows = {
        "wide_at": f"max(IF(close_exact IS NULL, row_no, NULL)) OVER ({series} {SO_FAR})",
        **_earlier_totals(CLOSE_TOTALS, series),
        **_running(RETURN_TOTALS, series),
        **_lags(2, series),
    }
    means = {f"sma_{length}d": sma(length) for length in BACK["close_sum"]}
    return _add(_add(rows, windows), means).selectExpr("*", *_extremes(2))


def _with_volatility(rows: DataFrame, series: str) -> DataFrame:
    """Deviations of returns, the range within a day, the place in the 52-week range."""

    def volatility(length: int) -> str:
        """Sample deviation of the log returns, from n, sum and sum of squares."""
        n, s = _trailing("log_n", length), _trailing("log_sum", length)
        squares = _trailing("log_sq_sum", length)
        variance = f"try_divide({n} * {squares} - {s} * {s}, {n} * ({n} - 1))"
        # Ticks of a percentage: SCALE * 100 of them make 1.
        deviation = f"sqrt({variance}) / {SCALE * 100}D"
        return rnd_sql(f"{deviation} * {math.sqrt(TRADING_DAYS)!r}D * 100", 4)

    day_range = f"try_divide({_trailing('range_sum', 20)} / {SCALE}D, {_trailing('range_n', 20)})"
    position = "try_divide(close_price - low_52w, high_52w - low_52w)"
    return _add(
        _add(rows, _earlier_totals(RETURN_TOTALS, series)),
        {
            "price_position_52w": rnd_sql(position, 4),
            "volatility_20d_annualized": volatility(20),
            "volatility_60d_annualized": volatility(60),
            "avg_intraday_range_pct_20d": rnd_sql(day_range, 4),
        },
    )


def ranged_by_ticker(stg: DataFrame) -> DataFrame:
    """Lay bars out by ranges of tickers before the windows.

    That layout serves the windows like a hash does and is already the order by
    ticker and date, so a later sort by these two moves nothing.
    """
    return stg.repartitionByRange("ticker")


def int_daily_returns(stg: DataFrame, slice_rows: int | None = None) -> DataFrame:
    return daily_signals(stg, slice_rows).select(RETURNS)


def int_moving_averages(stg: DataFrame, slice_rows: int | None = None) -> DataFrame:
    return daily_signals(stg, slice_rows).select(AVERAGES)


def int_volatility(stg: DataFrame, slice_rows: int | None = None) -> DataFrame:
    return daily_signals(stg, slice_rows).select(VOLATILITY)
