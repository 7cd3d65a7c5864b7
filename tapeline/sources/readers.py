"""Readers for raw files and the reference list."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    LongType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tapeline.sources.schemas import COMPANIES, INDICATORS, PRICES, SEED

FOOTERS_AT_ONCE = 16


def read_parquet_if_there(
    spark: SparkSession, path: str, schema: StructType
) -> DataFrame | None:
    """The files at ``path`` with the declared columns and types, or None if
    there are none.

    A column a file lacks reads as NULL; a column stored in another type is
    cast, file by file: files may store a column in different types, as pandas
    does with whole numbers once one is missing.  Times may be stored in
    nanoseconds, as pandas writes them.
    """
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        if e.getCondition() != "PARQUET_TYPE_ILLEGAL":
            raise
        stored = {f.name: LongType() for f in schema if _is_time(f)}
        return _read_as(spark, [path], stored, schema)
    groups = _by_types(spark, path, rows, schema)
    return reduce(
        DataFrame.unionByName,
        [_read_as(spark, files, dict(types), schema) for types, files in groups.items()],
    )


def _read_as(
    spark: SparkSession, paths: list[str], stored: dict[str, DataType], schema: StructType
) -> DataFrame:
    as_stored = StructType(
        [StructField(f.name, stored.get(f.name, f.dataType)) for f in schema]
    )
    rows = spark.read.schema(as_stored).parquet(*paths)
    return rows.select(*[_declared(f, as_stored[f.name].dataType) for f in schema])


def _by_types(
    spark: SparkSession, path: str, rows: DataFrame, schema: StructType
) -> dict[tuple, list[str]]:
    """The paths to read, by the types in which they store the declared columns:
    one path if all files agree, as a distributed look at their footers tells."""
    names = set(schema.names)

    def types(found: StructType) -> tuple:
        return tuple(sorted(((f.name, f.dataType) for f in found if f.name in names), key=str))

    try:
        merged = spark.read.option("mergeSchema", True).parquet(path).schema
        return {types(merged): [path]}
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    files = sorted(rows.inputFiles())
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        own = list(pool.map(lambda file: types(spark.read.parquet(file).schema), files))
    groups: dict[tuple, list[str]] = {}
    for kind, file in zip(own, files):
        groups.setdefault(kind, []).append(file)
    return groups


def _is_time(field: StructField) -> bool:
    return isinstance(field.dataType, (DateType, TimestampNTZType))


def _declared(field: StructField, stored: DataType) -> Column:
    value = F.col(field.name)
    if stored == field.dataType:
        return value
    if _is_time(field) and isinstance(stored, LongType):
        value = F.expr(
            f"timestampadd(MICROSECOND, {field.name} DIV 1000,"
            " TIMESTAMP_NTZ'1970-01-01 00:00:00')"
        )
    return value.cast(field.dataType).alias(field.name)


def read_prices(
    spark: SparkSession, raw_dir: str, extra: StructType | None = None
) -> DataFrame | None:
    """All ``*_prices.parquet`` as one table.  ``extra`` names further provider
    columns to pass through."""
    schema = StructType([*PRICES, *(extra or [])])
    return read_parquet_if_there(spark, f"{raw_dir}/*_prices.parquet", schema)


def read_companies(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    return read_parquet_if_there(spark, f"{raw_dir}/company_info.parquet", COMPANIES)


def read_indicators(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Macro observations; none at all if the file is absent."""
    path = f"{raw_dir}/economic_indicators.parquet"
    found = read_parquet_if_there(spark, path, INDICATORS)
    return found if found is not None else spark.createDataFrame([], INDICATORS)


def read_raw(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The raw tables that are there, by name; an empty folder gives none."""
    path = f"{raw_dir}/economic_indicators.parquet"
    found = {
        "raw_stock_prices": read_prices(spark, raw_dir),
        "raw_company_info": read_companies(spark, raw_dir),
        "raw_economic_indicators": read_parquet_if_there(spark, path, INDICATORS),
    }
    return {name: df for name, df in found.items() if df is not None}


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SEED, dateFormat="yyyy-MM-dd")
