"""Sinks and load summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(
    df: DataFrame, name: str, partition_by: str | None = None, buckets: int | None = None
) -> None:
    """Full replacement: running it twice leaves the same table.

    With ``partition_by`` rows are gathered by that column first, a large value
    split over several tasks, so that a folder gets few files.  With ``buckets``
    rows are stored hashed by ticker and sorted by ticker and date, one file a
    bucket: windows and aggregates per ticker then read them without a shuffle.
    """
    if partition_by is not None and buckets is not None:
        raise ValueError("a table is stored by a column or in buckets")
    if buckets is not None:
        rows = df.repartition(buckets, "ticker")
        stored = rows.write.mode("overwrite").bucketBy(buckets, "ticker")
        stored.sortBy("ticker", "trading_date").saveAsTable(name)
        return
    if partition_by is None:
        df.write.mode("overwrite").saveAsTable(name)
        return
    rows = df.hint("rebalance", partition_by)
    rows.write.mode("overwrite").partitionBy(partition_by).saveAsTable(name)


def materialize(
    df: DataFrame,
    name: str,
    layer: str,
    partition_by: str | None = None,
    buckets: int | None = None,
) -> None:
    """Marts become tables, staging and intermediate results views."""
    if layer == "marts":
        replace_table(df, name, partition_by, buckets)
    elif layer in ("staging", "intermediate"):
        df.createOrReplaceTempView(name)
    else:
        raise ValueError(f"unknown layer: {layer}")


def write_by_ticker(df: DataFrame, path: str) -> None:
    """One folder per ticker.  The rebalance hint gathers the rows of small
    tickers and splits a large one over several tasks and files."""
    df.hint("rebalance", "ticker").write.mode("overwrite").partitionBy(
        "ticker"
    ).parquet(path)


def write_series(df: DataFrame, path: str) -> None:
    """All series as one dataset; an error if there is nothing to write."""
    if df.isEmpty():
        raise RuntimeError("no observations to write")
    df.write.mode("overwrite").parquet(path)


def load_summary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, in one job."""
    lines = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in tables.items()
    ]
    if not lines:
        return spark.createDataFrame(
            [], "table_name string, row_count bigint, column_count int"
        )
    return reduce(DataFrame.unionByName, lines)
