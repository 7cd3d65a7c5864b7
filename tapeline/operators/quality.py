"""Data-quality checks.  Each returns the rows that break a rule; empty is good."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tapeline.operators.series import per_series

# Rules as predicates ---------------------------------------------------------


def breaks_ohlc() -> Column:
    return F.expr(
        "least(open_price, high_price, low_price, close_price) <= 0"
        " OR high_price < greatest(open_price, close_price, low_price)"
        " OR low_price > least(open_price, close_price)"
    )


def no_volume() -> Column:
    return F.expr("volume <= 0")


def large_return(limit: float = 75) -> Column:
    return F.expr(f"abs(daily_return_pct) > {limit}")


def odd_volatility(low: float = 0.1, high: float = 500) -> Column:
    return F.expr(f"NOT volatility_20d_annualized BETWEEN {low}D AND {high}D")


def large_gap(days: int = 7) -> Column:
    return F.expr(f"gap_days > {days}")


# Checks by row ---------------------------------------------------------------


def valid_ohlc(stg: DataFrame) -> DataFrame:
    return stg.filter(breaks_ohlc()).select(
        "price_id", "ticker", "trading_date",
        "open_price", "high_price", "low_price", "close_price",
    )


def positive_volume(raw: DataFrame) -> DataFrame:
    """On the raw bars, before staging drops the bad ones."""
    return raw.filter(no_volume()).select("ticker", "date", "volume")


def reasonable_daily_return(returns: DataFrame, limit: float = 75) -> DataFrame:
    return returns.filter(large_return(limit)).select(
        "price_id", "ticker", "trading_date", "daily_return_pct"
    )


def reasonable_volatility(
    volatility: DataFrame, low: float = 0.1, high: float = 500
) -> DataFrame:
    return volatility.filter(odd_volatility(low, high)).select(
        "price_id", "ticker", "trading_date", "volatility_20d_annualized"
    )


def with_gap_days(stg: DataFrame, slice_rows: int | None = None) -> DataFrame:
    """Date of the bar before and the days since; NULL on the first of a ticker."""

    def gaps(rows: DataFrame, keys: list[str]) -> DataFrame:
        before = f"PARTITION BY {', '.join(keys)} ORDER BY trading_date"
        return rows.withColumn(
            "prev_trading_date", F.expr(f"lag(trading_date) OVER ({before})")
        ).withColumn("gap_days", F.datediff("trading_date", "prev_trading_date"))

    return per_series(stg, gaps, slice_rows, reach=1)


def with_neighbours(stg: DataFrame) -> DataFrame:
    """The bars before and after, and the number of the bar within its ticker."""
    series = "PARTITION BY ticker ORDER BY trading_date"
    return with_gap_days(stg).withColumns(
        {
            "next_trading_date": F.expr(f"lead(trading_date) OVER ({series})"),
            "bar_no": F.expr(f"row_number() OVER ({series})"),
        }
    )


def no_large_date_gaps(
    stg: DataFrame, days: int = 7, slice_rows: int | None = None
) -> DataFrame:
    return (
        with_gap_days(stg.select("price_id", "ticker", "trading_date"), slice_rows)
        .filter(large_gap(days))
        .select("price_id", "ticker", "trading_date", "prev_trading_date", "gap_days")
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


# Checks by group -------------------------------------------------------------


def sufficient_history(stg: DataFrame, rows: int = 200) -> DataFrame:
    return (
        stg.groupBy("ticker")
        .agg(F.count("*").alias("trading_day_count"))
        .filter(F.col("trading_day_count") < rows)
    )


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is no value.

    Keys are hashes as hexadecimal text: such a text is shuffled as the bytes it stands
    for, half as long, and any other as it is."""
    value = F.col(column)
    groups = {"unique_field": value}
    if df.schema[column].dataType == StringType():
        is_hex = F.coalesce(F.lower(F.hex(F.unhex(value))) == value, F.lit(False))
        short = F.when(is_hex, F.unhex(value)).otherwise(value.cast("binary"))
        groups = {"short": short, "is_hex": is_hex}
    found = (
        df.filter(value.isNotNull())
        .groupBy(*[key.alias(name) for name, key in groups.items()])
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )
    if "short" in groups:
        text = F.when(F.col("is_hex"), F.lower(F.hex("short"))).otherwise(F.col("short").cast("string"))
        found = found.withColumn("unique_field", text)
    return found.select("unique_field", "n_records")


def tickers_in_dim(fact: DataFrame, companies: DataFrame) -> DataFrame:
    """Tickers without a company.  Distinct first: the join then sees one row
    per ticker, not one per bar."""
    return fact.select("ticker").distinct().join(companies, "ticker", "left_anti")


def dates_in_dim(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Trading dates the calendar does not have."""
    return (
        fact.select("trading_date")
        .distinct()
        .join(dates, F.col("trading_date") == F.col("calendar_date"), "left_anti")
    )


# Freshness and schema --------------------------------------------------------


def freshness(
    df: DataFrame,
    loaded_at: str = "extracted_at",
    warn: dt.timedelta = dt.timedelta(hours=25),
    error: dt.timedelta = dt.timedelta(hours=49),
    now: Column | dt.datetime | None = None,
) -> DataFrame:
    """Age of the newest load against two thresholds, in one row.

    Load times are wall-clock strings; ``now`` is taken as one too, so the age
    does not depend on the session time zone.
    """
    if now is None:
        now = F.current_timestamp()
    elif isinstance(now, dt.datetime):
        now = F.lit(now.isoformat())
    rows = df.agg(
        F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at")
    ).withColumn("now", now.cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("now"))
    status = (
        F.when(age <= int(warn.total_seconds()), "pass")
        .when(age <= int(error.total_seconds()), "warn")
        .otherwise("error")
    )
    return rows.select(
        "max_loaded_at", (age / 3600.0).alias("age_hours"), status.alias("status")
    )


FEED_WARN, FEED_ERROR = dt.timedelta(hours=25), dt.timedelta(hours=49)
MACRO_WARN, MACRO_ERROR = dt.timedelta(days=40), dt.timedelta(days=60)


def check_schema(df: DataFrame, declared: StructType) -> DataFrame:
    """Columns that differ from the declared type, or are missing, with the
    number of their values the declared type cannot hold.  One pass."""
    actual = {f.name: f.dataType for f in df.schema}
    wrong = [f for f in declared if actual.get(f.name) != f.dataType]

    def misfits(field) -> Column:
        if field.name not in actual:
            return F.count("*")
        value = F.col(field.name)
        return F.count_if(value.isNotNull() & value.try_cast(field.dataType).isNull())

    def line(field) -> Column:
        found = actual.get(field.name)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("declared_type"),
            F.lit(found.simpleString() if found else None).cast("string").alias(
                "actual_type"
            ),
            misfits(field).alias("misfits"),
        )

    if not wrong:
        return df.sparkSession.createDataFrame(
            [],
            "column_name string, declared_type string, actual_type string, misfits bigint",
        )
    return df.agg(F.array(*[line(f) for f in wrong]).alias("lines")).selectExpr(
        "inline(lines)"
    )


# Report ----------------------------------------------------------------------


def count_breaks(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Many counts over one frame in one pass, one line per check."""
    lines = ", ".join(f"'{name}', bigint(`{name}`)" for name in counts)
    return df.agg(*[count.alias(name) for name, count in counts.items()]).selectExpr(
        f"stack({len(counts)}, {lines}) AS (check_name, violations)"
    )


def count_rules(rules: dict[str, Column]) -> dict[str, Column]:
    return {name: F.count_if(rule) for name, rule in rules.items()}


def count_violations(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def nulls(*columns: str) -> dict[str, Column]:
    return {f"not_null_{c}": F.expr(f"{c} IS NULL") for c in columns}


def quality_report(counts: list[DataFrame]) -> DataFrame:
    """All counts as one table.  It reports; it does not stop a run."""
    report = counts[0]
    for other in counts[1:]:
        report = report.unionByName(other)
    return report.withColumn("passed", F.col("violations") == 0)
