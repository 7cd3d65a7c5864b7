"""Signals that follow the ingested bars without a rebuild of all history.

Three more datasets lie under an ingestion target, by month and slot like ``current``:

``depth``     staged bars per ticker in each month and slot
``signals``   the per-ticker columns of the fact, one row per staged bar, less the key,
              which is hashed from ticker and date again on reading

A changed bar moves the signals of itself and of the bars whose frames reach back to it,
and these reach back over REACH bars.  For each slot a batch touches, ``depth`` says in
which month the REACH bars before the first changed month start for every ticker, and in
which month the REACH bars behind the last changed one end.  Only the months between
are read from ``current``, and only those from the first changed one on are written.
Whole months and slots are computed anew from ``current`` and none of their rows is
copied, so a run that broke off repairs what it left when it runs again.
"""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeline.functions.labels import surrogate_key
from tapeline.operators.series import REACH
from tapeline.operators.signals import SIGNALS, daily_signals, with_signals
from tapeline.operators.staging import stg_stock_prices
from tapeline.plans import marts
from tapeline.streaming.ingest import (
    PLACE,
    SLOTS,
    UNDATED,
    freed_shuffles,
    in_parts,
    merge_prices,
    month_of,
    read_current,
    replace_parts,
    slot_of,
)

Parts = list[tuple[str, int]]
#: The signals in the files.
STORED = [c for c in SIGNALS if c != "price_id"]


def placed(rows: DataFrame, slots: int) -> DataFrame:
    return rows.withColumns({"month": month_of("trading_date"), "slot": slot_of("ticker", slots)})


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Some rows as part of the plan, so that no Python worker starts for them."""
    found = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(found))


def with_markers(rows: DataFrame, parts: Parts, spark: SparkSession) -> DataFrame:
    """The rows and an empty one for each part, so that a part whose bars are all gone is
    replaced too."""
    empty = literal_rows(spark, [dict(zip(PLACE, p)) for p in parts], "month: string, slot: int")
    return rows.unionByName(empty, allowMissingColumns=True)


def refresh_depth(spark: SparkSession, target: str, parts: Parts, slots: int) -> None:
    bars = placed(stg_stock_prices(read_current(spark, target).filter(in_parts(parts))), slots)
    counts = bars.groupBy(*PLACE, "ticker").agg(F.count("*").alias("bars"))
    rows = with_markers(counts, parts, spark).hint("rebalance", *PLACE)
    replace_parts(rows, f"{target}/depth")


def read_depth(spark: SparkSession, target: str) -> DataFrame:
    stored = spark.read.schema("ticker string, bars bigint, month string, slot int")
    return stored.parquet(f"{target}/depth").filter("bars IS NOT NULL")


def reach_of(spark: SparkSession, target: str, parts: Parts, reach: int = REACH) -> DataFrame:
    """Per touched slot the months to read from, to write from and to write up to:
    read_from, first, last.  Narrow: a row per ticker and month goes in."""
    touched = defaultdict(list)
    for month, slot in parts:
        touched[slot].append(month)
    ends = literal_rows(
        spark,
        [{"slot": slot, "first": min(m), "last": max(m)} for slot, m in touched.items()],
        "slot: int, first: string, last: string",
    )
    depth = read_depth(spark, target).filter(F.col("slot").isin(sorted(touched)))
    depth = depth.join(F.broadcast(ends), "slot")  # a row per slot
    is_before, is_after = F.col("month") < F.col("first"), F.col("month") > F.col("last")
    before = F.when(is_before, F.col("bars")).otherwise(0)
    after = F.when(is_after, F.col("bars")).otherwise(0)
    # months between the changed ones are read anyway
    ticker = Window.partitionBy("slot", "ticker").orderBy("month")  # one order, so one sort
    whole = ticker.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ticker.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a month is needed as long as the months nearer to the change do not reach far enough
    needed = depth.filter(is_before | is_after).withColumns(
        {
            "nearer_before": F.sum(before).over(whole) - F.sum(before).over(so_far),
            "nearer_after": F.sum(after).over(so_far) - after,
        }
    )
    lead = is_before & (F.col("nearer_before") < reach)
    tail = is_after & (F.col("nearer_after") < reach)
    found = needed.groupBy("slot").agg(
        F.min(F.when(lead, F.col("month"))).alias("lead"),
        F.max(F.when(tail, F.col("month"))).alias("tail"),
    )
    return ends.join(found, "slot", "left").select(
        "slot",
        F.coalesce("lead", "first").alias("read_from"),
        "first",
        F.coalesce("tail", "last").alias("last"),
    )


def refresh_signals(
    spark: SparkSession, target: str, parts: Parts, slots: int = SLOTS
) -> None:
    """Bring ``depth`` and ``signals`` up to date where parts of ``current`` changed.
    ``current`` has one bar per ticker and day, so series need no cutting."""
    parts = [p for p in parts if p[0] != UNDATED]
    if not parts:
        return
    with freed_shuffles(spark):
        refresh_depth(spark, target, parts, slots)
        # a row per slot: fixed in number
        spans = {r.slot: r for r in reach_of(spark, target, parts).collect()}
        of_slots = F.col("slot").isin(sorted(spans))
        # names of folders, not of bars: SLOTS a month at most
        months, filled = (
            {tuple(r) for r in rows.filter(of_slots).select(*PLACE).distinct().collect()}
            for rows in (read_current(spark, target), read_depth(spark, target))
        )
        read, write = [], []
        for month, slot in sorted(months):
            span = spans[slot]
            if month != UNDATED and span.read_from <= month <= span.last:
                read.append((month, slot))
                if month >= span.first:
                    write.append((month, slot))
        bars = stg_stock_prices(read_current(spark, target).filter(in_parts(read)))
        rows = signals_by_slot(bars, slots).filter(in_parts(write))
        emptied = [p for p in write if p not in filled]
        if emptied:
            rows = with_markers(rows, emptied, spark)
        replace_parts(rows, f"{target}/signals")


def signals_by_slot(bars: DataFrame, slots: int) -> DataFrame:
    """The stored signals with their place.  Bars are laid out by ranges of slot and ticker
    before the windows, so the wide rows behind these are written where they are: a task
    holds few slots."""
    laid = bars.withColumn("slot", slot_of("ticker", slots)).repartitionByRange("slot", "ticker")
    rows = with_signals(laid, keys=["slot", "ticker"])
    return rows.select(*STORED, month_of("trading_date").alias("month"), "slot")


def merge_and_refresh(
    batch: DataFrame, name: str, target: str, slots: int = SLOTS
) -> None:
    """Merge a batch of prices and bring the signals behind them up to date."""
    parts = merge_prices(batch, name, target, slots)
    refresh_signals(batch.sparkSession, target, parts, slots)


def read_signals(spark: SparkSession, target: str) -> DataFrame:
    """The stored signals: those of ``daily_signals`` over all ingested bars."""
    schema = daily_signals(stg_stock_prices(read_current(spark, target))).select(STORED).schema
    places = "month string, slot int"
    stored = spark.read.schema(
        ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", " + places
    ).parquet(f"{target}/signals")
    key = surrogate_key(F.col("ticker"), F.col("trading_date"))
    return stored.filter("trading_date IS NOT NULL").withColumn("price_id", key).select(SIGNALS)


def read_fact(spark: SparkSession, target: str, companies: DataFrame, macro: DataFrame) -> DataFrame:
    """The fact over the stored signals.  Company and macro columns are joined on reading:
    both are small, and a changed one would touch rows of every ticker."""
    return marts.assemble_fact(read_signals(spark, target), companies, macro)
