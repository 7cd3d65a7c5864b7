"""Shaping of freshly extracted rows, and figures about them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: History kept by default: two years of prices, five of macro series.
PRICE_DAYS = 730
MACRO_DAYS = 5 * 365

# Largest median gap in days that still counts as the frequency.
FREQUENCIES = [(1, "daily"), (8, "weekly"), (35, "monthly"), (100, "quarterly")]


def concat_by_name(dfs: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def stamp(df: DataFrame, at: str | None = None, **keys: str) -> DataFrame:
    """Add constant columns, such as the ticker, and the time of extraction."""
    at = at or dt.datetime.now().isoformat()
    values = {**keys, "extracted_at": at}
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def restrict_history(
    df: DataFrame,
    date: str = "date",
    start: dt.date | None = None,
    end: dt.date | None = None,
    days: int = PRICE_DAYS,
    through_end: bool = False,
) -> DataFrame:
    """Rows from start up to end, by default the last ``days`` days.  Prices stop
    before the end; macro series go ``through_end``, with all times of that day.
    Plain comparisons on the column, so they reach the file scan."""
    end = end or dt.date.today()
    start = start or end - dt.timedelta(days=days)
    stop = end + dt.timedelta(days=1) if through_end else end
    return df.filter((F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(stop)))


def infer_frequency(observations: DataFrame) -> DataFrame:
    """Reporting frequency per series, from the median gap between observations.

    Observations collapse to one row per series and day, with a count; repeats
    of a day enter the median as that many gaps of zero.  No group holds more
    rows than the calendar has days.
    """
    series = Window.partitionBy("series_id").orderBy("observation_date")
    gap = F.datediff("observation_date", F.lag("observation_date").over(series))
    days = (
        observations.groupBy("series_id", "observation_date")
        .agg(F.count("*").alias("n"))
        .withColumn("gap", gap)
    )
    gaps = F.array(
        F.struct(F.col("gap"), F.lit(1).cast("bigint").alias("times")),
        F.struct(F.lit(0).alias("gap"), (F.col("n") - 1).alias("times")),
    )
    weighted = days.select("series_id", F.explode(gaps).alias("g")).select(
        "series_id", "g.*"
    )
    median = F.percentile("gap", 0.5, F.col("times"))
    return (
        weighted.groupBy("series_id")
        .agg(F.floor(median).cast("int").alias("median_gap_days"))
        .withColumn("frequency", _frequency(F.col("median_gap_days")))
    )


def _frequency(days: Column) -> Column:
    label = F.lit("annual")
    for limit, name in reversed(FREQUENCIES):
        label = F.when(days <= limit, name).otherwise(label)
    return F.when(days.isNull(), "unknown").otherwise(label)


def extract_stats(df: DataFrame, key: str, date: str) -> DataFrame:
    """Rows and date range per series or ticker."""
    return df.groupBy(key).agg(
        F.count("*").alias("row_count"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )
