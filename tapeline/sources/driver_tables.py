"""The raw price, company and indicator tables, derived from the TPC-H-like tables.

A line item is a trade: its supplier is the ticker, price is extended price over
quantity.  Orders give the macro series.  ``FIXTURES.md`` holds the mapping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTRACTED_AT = "2001-11-05T00:00:00"


# The columns used, with their types.  A declared schema spares
# the job that would open a file to infer one.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint,"
    " l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars.  A supplier has few trades a day, so bars of a task would be about as
    many as its trades, and wider: trades are dealt by supplier and day first.  Tasks that
    read hold nothing then, however much they read, and a supplier with a third of all
    trades is spread by its days."""
    day = F.col("l_shipdate").cast("date")
    trades = (
        table(spark, sf_dir, "lineitem")
        .withColumn("date", day)
        .drop("l_shipdate")
        .repartition("l_suppkey", "date")
    )
    price = F.col("l_extendedprice") / F.col("l_quantity")
    # The order of trades within a day; the price rides along in the minimum.
    place = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    trade = F.struct(*place, price.alias("price"))
    bars = trades.groupBy("l_suppkey", "date").agg(
        F.min(trade)["price"].alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max(trade)["price"].alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("ticker")
    )
    return bars.join(names, "l_suppkey").select(
        "date", "ticker", "open", "high", "low", "close", "volume",
        F.lit(EXTRACTED_AT).alias("extracted_at"),
    )


def dirty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars with faults by day of month: 13 no volume, 17 high and low
    swapped, 19 no close, 23 row repeated."""
    day = F.dayofmonth("date")
    copies = F.when(day == 23, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return raw_prices(spark, sf_dir).select(
        "date",
        "ticker",
        "open",
        F.when(day == 17, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(day == 17, F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(day != 19, F.col("close")).alias("close"),
        F.when(day == 13, 0).otherwise(F.col("volume")).cast("bigint").alias("volume"),
        "extracted_at",
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def raw_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", "n_name")
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    balance = F.col("s_acctbal")
    return (
        table(spark, sf_dir, "supplier")
        .join(home, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_name").alias("ticker"),
            F.col("s_name").alias("company_name"),
            F.when(F.col("s_nationkey") % 7 != 0, F.col("n_name")).alias("sector"),
            F.col("r_name").alias("industry"),
            F.when(balance >= 0, (balance * 2e8).cast("bigint")).alias("market_cap"),
            F.lit(None).cast("string").alias("currency"),
            F.lit("X").alias("exchange"),
            F.col("r_name").alias("country"),
            F.lit(None).cast("string").alias("website"),
            F.lit(EXTRACTED_AT).alias("extracted_at"),
        )
    )


def companies_without(spark: SparkSession, sf_dir: str, nationkey: int) -> DataFrame:
    """Companies less those of one nation, so that their bars become orphans."""
    kept = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") != nationkey)
    return raw_companies(spark, sf_dir).join(
        kept.select(F.col("s_name").alias("ticker")), "ticker", "left_semi"
    )


# Series, its name, frequency, period, the trade of the period that
# counts, and how its total becomes a value.
INDICATORS = [
    ("FEDFUNDS", "Federal funds rate", "monthly", "MONTH", "first", "v / 80000"),
    ("CPIAUCSL", "Consumer prices", "monthly", "MONTH", "last", "v / 1000"),
    ("UNRATE", "Unemployment rate", "monthly", "MONTH", "first_low", "v / 50000"),
    ("DGS10", "10-year yield", "daily", "DAY", "first", "v / 80000"),
    ("A191RL1Q225SBEA", "GDP growth", "quarterly", "QUARTER", "last", "v / 80000 - 3"),
    ("T10YIE", "10-year breakeven", "daily", "DAY", "last", "v / 160000"),
]


def raw_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six series from one pass over the orders.

    Orders collapse map-side to one row per day; months and quarters are then
    built from the days, not from the orders again."""
    days = (
        table(spark, sf_dir, "orders")
        .groupBy(F.expr("CAST(o_orderdate AS DATE) AS day"))
        .agg(
            F.expr("min_by(o_totalprice, o_orderkey) AS first"),
            F.expr("min(o_orderkey) AS first_key"),
            F.expr("max_by(o_totalprice, o_orderkey) AS last"),
            F.expr("-max(o_orderkey) AS last_key"),
            F.expr(f"min_by(o_totalprice, o_orderkey) FILTER ({LOW}) AS first_low"),
            F.expr(f"min(o_orderkey) FILTER ({LOW}) AS first_low_key"),
        )
    )
    lines = ", ".join(
        f"'{series}', {'day' if period == 'DAY' else f'trunc(day, {period!r})'},"
        f" {pick}_key, {pick}"
        for series, _, _, period, pick, _ in INDICATORS
    )
    value, name, frequency = (
        "CASE series_id "
        + " ".join(f"WHEN '{row[0]}' THEN {show(row)}" for row in INDICATORS)
        + " END"
        for show in (
            lambda row: row[5], lambda row: f"'{row[1]}'", lambda row: f"'{row[2]}'"
        )
    )
    return (
        days.selectExpr(
            f"stack({len(INDICATORS)}, {lines}) AS (series_id, observation_date, k, v)"
        )
        .filter("k IS NOT NULL")
        .groupBy("series_id", "observation_date")
        .agg(F.expr("min_by(v, k) AS v"))
        .selectExpr(
            "observation_date",
            f"{value} AS value",
            "series_id",
            f"{name} AS series_name",
            f"{frequency} AS frequency",
            f"'{EXTRACTED_AT}' AS extracted_at",
        )
    )


LOW = "WHERE o_orderpriority = '5-LOW'"
