"""Signals kept up to date by batches: equal to a full rebuild, and no more is touched."""

import datetime as dt
import random
import re
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from frames import LOADED, bars, companies, observations
from tapeline.operators.macro import int_macro_context
from tapeline.operators.signals import SIGNALS, daily_signals
from tapeline.operators.staging import stg_company_info, stg_economic_indicators, stg_stock_prices
from tapeline.plans import marts
from tapeline.sources.schemas import PRICES
from tapeline.streaming import incremental, ingest

START = dt.date(2020, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(SIGNALS).collect()), key=str)


def rebuilt(spark, target):
    return rows_of(daily_signals(stg_stock_prices(ingest.read_ingested(spark, target))))


def batch(spark, some, loaded):
    """(ticker, day, close) as bars of one load."""
    rows = [
        (dt.datetime.combine(START + dt.timedelta(days=d), dt.time()), t, c, c and c + 1, c and c - 1, c, 100 + d, loaded)
        for t, d, c in some
    ]
    return spark.createDataFrame(rows, PRICES)


def stamps(target, kind="signals"):
    return {str(p): p.stat().st_mtime_ns for p in Path(target, kind).rglob("*.parquet")}


def parts_of(paths, target, kind="signals"):
    return {str(Path(p).parent.relative_to(Path(target, kind))) for p in paths}


@pytest.fixture(scope="module")
def target(spark, tmp_path_factory):
    """Three tickers of 800 days, one of them with gaps of weeks, and one of 20 days."""
    folder = str(tmp_path_factory.mktemp("target"))
    luck = random.Random(1)
    some = [(t, d, round(luck.uniform(1, 99), 2)) for t in ("AAA", "BBB") for d in range(800)]
    some += [("GAP", d, 5.0 + d % 7) for d in range(0, 800, 9)] + [("NEW", d, 3.0) for d in range(780, 800)]
    incremental.merge_and_refresh(batch(spark, some, LOADED), "b-00", folder)
    return folder


def test_the_first_batch_builds_all(spark, target):
    assert rows_of(incremental.read_signals(spark, target)) == rebuilt(spark, target)


@pytest.mark.parametrize(
    "name, some",
    [
        ("b-01", [("AAA", 800, 50.0), ("BBB", 800, 51.0)]),  # the next day
        ("b-02", [("AAA", 300, 1000.0)]),  # corrected
        ("b-03", [("BBB", 10, None), ("GAP", 4, 7.0)]),  # gone, and late between two bars
        ("b-04", [("AAA", 801, 9.0), ("AAA", 801, 9.0), ("OLD", 2, 1.0), ("OLD", 700, 2.0)]),  # repeated; a new ticker
        ("b-05", [("GAP", d, None) for d in range(0, 800, 9)]),  # a ticker without bars
    ],
)
def test_batches_give_what_a_rebuild_gives(spark, target, name, some):
    before = stamps(target)
    slots = {r[0] for r in batch(spark, some, LOADED).select(ingest.slot_of("ticker")).collect()}
    for _ in range(2):  # a batch that runs again changes nothing
        incremental.merge_and_refresh(batch(spark, some, f"2024-02-{name[2:]}"), name, target)
        assert rows_of(incremental.read_signals(spark, target)) == rebuilt(spark, target)
    after = stamps(target)
    written = parts_of({p for p, s in after.items() if before.get(p) != s}, target)
    kept = parts_of(before, target) - written
    assert kept and {int(p.split("slot=")[1]) for p in written} <= slots
    first = min(d for _, d, _ in some)
    month = f"month={START + dt.timedelta(days=first):%Y-%m}"
    assert min(written) >= month


def test_a_batch_reads_and_writes_the_tail_alone(spark, target):
    slot = batch(spark, [("AAA", 0, 1.0)], LOADED).select(ingest.slot_of("ticker")).first()[0]
    span = incremental.reach_of(spark, target, [("2022-03", slot)]).first()
    # 252 bars lie in the nine months before
    assert (span.read_from, span.first, span.last) == ("2021-06", "2022-03", "2022-03")
    span = incremental.reach_of(spark, target, [("2020-03", slot), ("2020-05", slot)]).first()
    assert (span.read_from, span.first, span.last) == ("2020-01", "2020-03", "2021-02")


def test_a_part_lost_on_the_way_comes_back(spark, target):
    some = [("AAA", 790, 42.0)]
    incremental.merge_and_refresh(batch(spark, some, "2024-03-01"), "b-06", target)
    day = START + dt.timedelta(days=790)
    shutil.rmtree(next(Path(target, "signals", f"month={day:%Y-%m}").glob("slot=*")))
    incremental.merge_and_refresh(batch(spark, some, "2024-03-01"), "b-06", target)
    incremental.refresh_signals(
        spark, target, [tuple(r) for r in ingest.read_current(spark, target).select(*ingest.PLACE).distinct().collect()]
    )
    assert rows_of(incremental.read_signals(spark, target)) == rebuilt(spark, target)


def test_nothing_and_undated_bars(spark, tmp_path):
    target = str(tmp_path)
    dated = bars(spark, [1.0, 2.0], "AAA")
    undated = dated.withColumn("date", F.lit(None).cast("timestamp_ntz"))
    incremental.merge_and_refresh(dated.unionByName(undated), "b-1", target)
    incremental.merge_and_refresh(dated.limit(0), "b-2", target)
    incremental.merge_and_refresh(undated, "b-3", target)
    assert [r.close_price for r in incremental.read_signals(spark, target).orderBy("trading_date").collect()] == [1.0, 2.0]


def test_fact_over_files_that_landed(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    Path(source).mkdir()
    about = stg_company_info(companies(spark, ("AAA", "Tech", "Chips", 1)))
    seen = stg_economic_indicators(observations(spark, ("FEDFUNDS", dt.date(2024, 1, 2), 5.0)))
    for n, closes in enumerate(([1.0, 2.0], [3.0])):
        start = dt.date(2024, 1, 1 + 2 * n)
        bars(spark, closes, "AAA", start=start).coalesce(1).write.parquet(str(tmp_path / f"tmp{n}"))
        part = next((tmp_path / f"tmp{n}").glob("part-*"))
        (Path(source) / f"{n}_prices.parquet").write_bytes(part.read_bytes())
        ingest.ingest_new_files(spark, source, target, state, with_signals=True).awaitTermination()
    stg = stg_stock_prices(ingest.read_ingested(spark, target))
    got = incremental.read_fact(spark, target, about, int_macro_context(stg, seen))
    want = marts.fct_daily_trading(stg, about, seen)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 3


def test_months_are_those_of_the_format(spark):
    days = ["0001-01-01", "0999-12-31", "1000-01-01", "1998-05-31", "2001-11-04", "9999-12-31", "+10000-02-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    both = df.select(ingest.month_of("d"), F.coalesce(F.date_format("d", "yyyy-MM"), F.lit(ingest.UNDATED))).collect()
    assert [r[0] for r in both] == [r[1] for r in both] and both[3][0] == "1998-05"


def test_the_reach_takes_one_sort_and_no_python_rows(spark, target):
    span = incremental.reach_of(spark, target, [("2020-03", 1), ("2020-05", 1)])
    plan = span._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == 1 and "ExistingRDD" not in plan
    marked = incremental.with_markers(span.limit(0), [("2020-03", 1), ("undated", 2)], spark)
    assert "ExistingRDD" not in marked._jdf.queryExecution().sparkPlan().toString()
    assert [(r.month, r.slot) for r in marked.collect()] == [("2020-03", 1), ("undated", 2)]


def plans(spark, *frames):
    """Executed plans as they stand before the first stage has run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    found = [df._jdf.queryExecution().executedPlan() for df in frames]
    text = [p.toString() for p in found]
    spark.conf.unset("spark.sql.adaptive.enabled")
    return found, text


def test_rows_are_moved_once_on_their_way_to_a_dataset(spark, target):
    landed = spark.read.schema(ingest.LANDED).parquet(f"{target}/landed")
    stg = stg_stock_prices(ingest.read_current(spark, target))
    found, text = plans(spark, ingest.latest_load(landed), incremental.signals_by_slot(stg, 32))
    for plan in text:
        moved = re.findall(r"Exchange (\w+)", plan)
        assert moved == ["rangepartitioning"], plan
        assert len(re.findall(r"\bSort \[", plan)) == 1  # the file writer's own comes later
    # the wide rows behind the windows are those of daily_signals, less the key
    assert "md5" not in text[1] and "price_id" not in incremental.STORED
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenStringSeq(found[1])
    assert max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) < 8_000


def test_no_shuffle_files_stay_behind_a_batch(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = (Path(f).name for f in blocks.getAllFiles().mkString("\n").split("\n"))
        return {f for f in files if f.startswith("shuffle_")}

    name, before = ingest.FREED, shuffles()
    some = [(t, d, 5.0 + d) for t in ("AAA", "BBB") for d in range(100)]
    spark.conf.set(name, "false")
    for n in range(2):
        incremental.merge_and_refresh(batch(spark, some, f"2024-0{n + 1}-01"), f"b-{n}", str(tmp_path))
    until = time.monotonic() + 20  # the block managers are told, not waited for
    while shuffles() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(name) == "false"  # as it was
    spark.conf.unset(name)
    assert rows_of(incremental.read_signals(spark, str(tmp_path))) == rebuilt(spark, str(tmp_path))


def test_only_emptied_parts_are_marked(spark, tmp_path):
    target, some = str(tmp_path), [("AAA", d, 1.0 + d) for d in range(60)]
    incremental.merge_and_refresh(batch(spark, some, LOADED), "b-0", target)
    gone = [("AAA", d, None) for d in range(31, 60)]  # all of February
    incremental.merge_and_refresh(batch(spark, gone, "2024-02-01"), "b-1", target)
    stored = spark.read.parquet(f"{target}/signals").groupBy("month").agg(
        F.count("*").alias("rows"), F.count("trading_date").alias("bars")
    )
    assert {r.month: (r.rows, r.bars) for r in stored.collect()} == {"2020-01": (31, 31), "2020-02": (1, 0)}
    assert rows_of(incremental.read_signals(spark, target)) == rebuilt(spark, target)
