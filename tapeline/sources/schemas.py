"""Declared schemas of the raw tables and of the reference list."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

PRICES = (
    StructType()
    .add("date", TimestampNTZType())
    .add("ticker", StringType())
    .add("open", DoubleType())
    .add("high", DoubleType())
    .add("low", DoubleType())
    .add("close", DoubleType())
    .add("volume", LongType())
    .add("extracted_at", StringType())
)

COMPANIES = (
    StructType()
    .add("ticker", StringType())
    .add("company_name", StringType())
    .add("sector", StringType())
    .add("industry", StringType())
    .add("market_cap", LongType())
    .add("currency", StringType())
    .add("exchange", StringType())
    .add("country", StringType())
    .add("website", StringType())
    .add("extracted_at", StringType())
)

INDICATORS = (
    StructType()
    .add("observation_date", DateType())
    .add("value", DoubleType())
    .add("series_id", StringType())
    .add("series_name", StringType())
    .add("frequency", StringType())
    .add("extracted_at", StringType())
)

SEED = (
    StructType()
    .add("ticker", StringType())
    .add("company_name", StringType())
    .add("sector", StringType())
    .add("industry", StringType())
    .add("index_weight_pct", DoubleType())
    .add("added_date", DateType())
)
