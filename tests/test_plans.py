"""What the plans of the market queries hold, whatever the size of their input."""

import re
from contextlib import contextmanager

import pytest

from tapeline.operators import quality, signals
from tapeline.operators.staging import stg_stock_prices
from tapeline.plans.registry import QUERIES
from tests.frames import bars

#: Bytes from which on the JVM does not compile a method.
HUGE_METHOD = 8_000


@contextmanager
def settings(spark, **values):
    names = {k.replace("_", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


@pytest.mark.parametrize("name", ["fct_daily_trading", "sliced_signals", "int_moving_averages"])
def test_generated_code_is_compiled(name, spark, sf_dir):
    package = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    with settings(spark, spark_sql_adaptive_enabled="false"):
        found = getattr(package, "MODULE$").codegenStringSeq(plan_of(QUERIES[name](spark, sf_dir)))
    assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())) < HUGE_METHOD


def test_signals_take_one_sort(spark):
    with settings(spark, spark_sql_adaptive_enabled="false"):
        rows = signals.daily_signals(stg_stock_prices(bars(spark, [1.0, 2.0])))
        plan = plan_of(rows).toString()
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert len(re.findall(r"\bExchange ", plan)) == 1


def test_bars_are_not_moved_by_date(spark, sf_dir):
    with settings(
        spark, spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1"
    ):
        plan = plan_of(QUERIES["fct_daily_trading"](spark, sf_dir)).toString()
    joins = re.findall(r"(\w+Join) \[trading_date", plan)
    assert joins == ["BroadcastHashJoin"]


def test_range_of_52_weeks_row_by_row(spark):
    closes = [float((i * 7919) % 1009 + 1) for i in range(800)]
    rows = signals.daily_signals(stg_stock_prices(bars(spark, closes))).orderBy("trading_date")
    found = [(r["high_52w"], r["low_52w"]) for r in rows.select("high_52w", "low_52w").collect()]
    frames = [closes[max(0, i - 251) : i + 1] for i in range(len(closes))]
    assert found == [(max(f), min(f)) for f in frames]


def test_price_history_takes_one_sort_of_bars(spark, sf_dir):
    with settings(spark, spark_sql_adaptive_enabled="false"):
        plan = plan_of(QUERIES["price_history"](spark, sf_dir)).toString()
    assert len(re.findall(r"\bSort \[ticker", plan)) == 1


@pytest.mark.parametrize("name", ["price_history", "daily_movers"])
def test_tasks_that_read_trades_sort_nothing(spark, sf_dir, name):
    with settings(spark, spark_sql_adaptive_enabled="false"):
        plan = plan_of(QUERIES[name](spark, sf_dir)).toString()
    reads = [p.split("Exchange ")[-1] for p in re.findall(r".*?Scan parquet[^\n]*", plan, re.DOTALL) if "lineitem" in p]
    assert reads and not any(re.search(r"\bSort |Aggregate", r) for r in reads)


def test_unique_moves_hashes_as_bytes(spark):
    values = ["00ff", "00ff", "00FF", "00FF", "0ff", "0ff", "\x00", "00", "00", "x", "x", "", "", None, None, "ab"]
    df = spark.createDataFrame([(v,) for v in values], "k string")
    found = quality.unique(df, "k")
    assert {tuple(r) for r in found.collect()} == {(v, 2) for v in ["00ff", "00FF", "0ff", "00", "x", ""]}
    assert "unhex" in plan_of(found).toString()
