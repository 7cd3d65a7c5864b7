"""Newly landed price files, each picked up once, merged into a dataset.

Two datasets lie under the target: ``landed`` keeps every batch as it came, and
``current`` holds one row per ticker and date, the one loaded last.  Both are laid out by
month and by slot, a hash of the ticker.  ``current`` is rebuilt from ``landed``, only for
the months and slots a batch touches.  A batch that runs again after a failure replaces
its own part of ``landed`` and rebuilds the same part of ``current``, so nothing is lost
or doubled at whatever point it broke off.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tapeline.sources.schemas import PRICES

KEY = ["ticker", "date"]
FIELDS = [f.name for f in PRICES]
PLACE = ["month", "slot"]
PLACED = StructType(
    [*PRICES, StructField("month", StringType()), StructField("slot", IntegerType())]
)
LANDED = StructType([*PLACED, StructField("batch", StringType())])
#: Whether a query removes its shuffle files when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The month of bars without a date.
UNDATED = "undated"
#: Parts of a month, unless a caller names another number.  A batch rewrites whole parts,
#: so more of them mean less to write for a batch of few tickers, and more files.  The
#: number is fixed for the life of a target.
SLOTS = 32


def latest_load(rows: DataFrame) -> DataFrame:
    """One row per ticker and date, the one loaded last: of the latest extraction,
    and of several with that time from the latest batch, by its name.  Only bars of
    one batch are settled by their figures.  A maximum, so repeated loads of a bar stream
    through one task without being held.

    Rows are dealt by ranges of their place first: the maximum and the files written from
    it share that one exchange."""
    rest = [c for c in FIELDS if c not in (*KEY, "extracted_at")]
    newest = F.max(F.struct("extracted_at", "batch", *rest)).alias("newest")
    dealt = rows.repartitionByRange(*PLACE, *KEY)
    # The sort below compares the first bytes of the first key, which tickers share.
    found = dealt.groupBy(*reversed(KEY), *PLACE).agg(newest)
    return found.select(*KEY, *PLACE, "newest.*").select(*FIELDS, *PLACE)


def month_of(date: str | Column) -> Column:
    """yyyy-MM, for the usual years from numbers, which is much quicker than a format."""
    year, month = F.year(date), F.month(date)
    usual = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
    named = F.when(year.between(1000, 9999), usual).otherwise(F.date_format(date, "yyyy-MM"))
    return F.coalesce(named, F.lit(UNDATED))


def slot_of(ticker: str | Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(ticker), F.lit(slots)).cast("int")


def with_place(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    return rows.select(
        *FIELDS, month_of("date").alias("month"), slot_of("ticker", slots).alias("slot")
    )


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside remove their shuffle files as they end.  Else these stay until
    the driver happens to collect its garbage, and those of all steps add up on disk."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def write_parts(rows: DataFrame, path: str, **options: str) -> None:
    writer = rows.write.mode("overwrite").options(compression="zstd", **options)
    writer.partitionBy(*PLACE).parquet(path)


def replace_parts(rows: DataFrame, path: str) -> None:
    """Replaces the months and slots that rows has, and leaves the others as they are.
    Each task writes a file for every part it holds rows of: rows come laid out by slot or
    month, so that these are few."""
    write_parts(rows, path, partitionOverwriteMode="dynamic")


def in_parts(parts: Iterable[tuple[str, int]]) -> Column:
    """Whether a row lies in one of the (month, slot): as literals these prune the
    folders read.  Slots of the same months share a condition."""
    months = defaultdict(set)
    for month, slot in parts:
        months[slot].add(month)
    slots = defaultdict(list)
    for slot, some in months.items():
        slots[frozenset(some)].append(slot)
    found = F.lit(False)
    for some, of in slots.items():
        found = found | (F.col("month").isin(sorted(some)) & F.col("slot").isin(sorted(of)))
    return found


def merge_prices(
    batch: DataFrame, name: str, target: str, slots: int = SLOTS
) -> list[tuple[str, int]]:
    """Keep a batch under its name and bring what it touches up to date; the months and
    slots touched.  Names of later batches sort behind those of earlier ones."""
    spark = batch.sparkSession
    mine = f"{target}/landed/batch={name}"
    with freed_shuffles(spark):
        write_parts(with_place(batch, slots).hint("rebalance", *PLACE), mine)
        landed = spark.read.schema(LANDED).parquet(f"{target}/landed")
        # At most ``slots`` values a month reach the driver.
        touched = spark.read.schema(PLACED).parquet(mine).select(*PLACE).distinct()
        parts = [tuple(row) for row in touched.collect()]
        if parts:
            replace_parts(latest_load(landed.filter(in_parts(parts))), f"{target}/current")
    return parts


def read_current(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(PLACED).parquet(f"{target}/current")


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    return read_current(spark, target).select(FIELDS)


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    with_signals: bool = False,
    slots: int = SLOTS,
) -> StreamingQuery:
    """Process the files that landed in ``source`` since the last run, then stop.

    ``with_signals`` also brings the stored signals of the target up to date, see
    ``incremental``.  The checkpoint remembers the files; keep it and the target on
    shared storage.
    """
    from tapeline.streaming.incremental import merge_and_refresh

    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def merge(batch: DataFrame, number: int) -> None:
        step = merge_and_refresh if with_signals else merge_prices
        step(batch, f"{stream}-{number:012d}", target, slots)

    landed = (
        spark.readStream.schema(PRICES)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*_prices.parquet")
        .parquet(source)
    )
    return (
        landed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
