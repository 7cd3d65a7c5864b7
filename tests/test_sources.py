import datetime as dt
import shutil
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from frames import bars, by, column, companies, day, observations
from tapeline.operators import performance, quality, reports
from tapeline.operators.signals import daily_signals
from tapeline.operators.staging import enrich_from_seed, stg_company_info, stg_stock_prices
from tapeline.plans.daily_run import build_marts
from tapeline.plans.data_tests import NOT_NULL, UNIQUE, data_tests
from tapeline.sources import readers, schemas, shaping, writers
from tapeline.streaming.ingest import ingest_new_files, merge_prices, read_ingested


@pytest.fixture
def raw_dir(spark, tmp_path):
    def save(df, name):
        df.coalesce(1).write.parquet(str(tmp_path / name))

    save(bars(spark, [184.5, 185.0, 187.5], "AAPL"), "aapl_prices.parquet")
    save(bars(spark, [10.0, 11.0], "MSFT").withColumn("dividends", F.lit(0.5)),
         "msft_prices.parquet")
    save(companies(spark, ("AAPL", "Technology", "Phones", 3 * 10**12)),
         "company_info.parquet")
    return str(tmp_path)


def test_all_price_files_are_one_table(spark, raw_dir):
    prices = readers.read_prices(spark, raw_dir)
    assert prices.schema == schemas.PRICES
    assert prices.count() == 5
    assert readers.read_companies(spark, raw_dir).count() == 1


def test_provider_columns_pass_through(spark, raw_dir):
    extra = StructType().add("dividends", "double")
    rows = by(readers.read_prices(spark, raw_dir, extra), "ticker", "date")
    assert {k[0]: r["dividends"] is None for k, r in rows.items()} == {
        "AAPL": True, "MSFT": False,
    }


@pytest.mark.parametrize("unit", ["ns", "us", "ms"])
def test_files_written_by_pandas(spark, tmp_path, unit):
    dates = pd.to_datetime(["2024-01-02", "2024-01-03"]).astype(f"datetime64[{unit}]")
    pd.DataFrame(
        {
            "date": dates, "ticker": "AAA", "open": 1.0, "high": 2.0, "low": 1.0,
            "close": 2.0, "volume": [5, 6], "stock_splits": 0.0, "extracted_at": "x",
        }
    ).to_parquet(tmp_path / "aaa_prices.parquet", index=False)
    pd.DataFrame(
        {
            "observation_date": dates, "value": [1.0, 2.0], "series_id": "S",
            "series_name": "s", "frequency": "daily", "extracted_at": "x",
        }
    ).to_parquet(tmp_path / "economic_indicators.parquet", index=False)
    prices = readers.read_prices(spark, str(tmp_path))
    found = readers.read_indicators(spark, str(tmp_path))
    assert (prices.schema, found.schema) == (schemas.PRICES, schemas.INDICATORS)
    want = [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert sorted(r.date.date() for r in prices.collect()) == want
    assert sorted(r.observation_date for r in found.collect()) == want


def test_absent_indicators_are_no_error(spark, raw_dir):
    found = readers.read_indicators(spark, raw_dir)
    assert found.schema == schemas.INDICATORS and found.isEmpty()


def test_empty_folder_gives_no_tables(spark, tmp_path):
    assert readers.read_raw(spark, str(tmp_path)) == {}
    assert writers.load_summary(spark, {}).collect() == []


def test_load_summary(spark, raw_dir):
    rows = writers.load_summary(spark, readers.read_raw(spark, raw_dir)).collect()
    assert {tuple(r) for r in rows} == {
        ("raw_stock_prices", 5, 8), ("raw_company_info", 1, 10),
    }


def test_replacing_twice_leaves_the_same_table(spark, raw_dir):
    for _ in range(2):
        writers.replace_table(readers.read_prices(spark, raw_dir), "prices_twice")
    assert spark.table("prices_twice").count() == 5


def test_layers(spark):
    df = spark.range(3)
    writers.materialize(df, "a_view", "staging")
    writers.materialize(df, "a_table", "marts")
    kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
    assert (kinds["a_view"], kinds["a_table"]) == ("TEMPORARY", "MANAGED")
    with pytest.raises(ValueError):
        writers.materialize(df, "x", "other")


def test_one_folder_per_ticker(spark, raw_dir, tmp_path):
    out = str(tmp_path / "out")
    writers.write_by_ticker(readers.read_prices(spark, raw_dir), out)
    assert {p.name for p in Path(out).glob("ticker=*")} == {"ticker=AAPL", "ticker=MSFT"}
    assert spark.read.parquet(out).count() == 5


def test_no_series_is_an_error(spark, tmp_path):
    out = str(tmp_path / "series")
    with pytest.raises(RuntimeError):
        writers.write_series(observations(spark), out)
    writers.write_series(observations(spark, ("CPIAUCSL", dt.date(2024, 1, 1), 1.0)), out)
    assert spark.read.parquet(out).count() == 1


def test_seed(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        "ticker,company_name,sector,industry,index_weight_pct,added_date\n"
        "AAA,Alpha Inc.,Energy,Oil,1.5,2001-02-03\n"
    )
    seed = readers.read_seed(spark, str(path))
    assert seed.schema == schemas.SEED
    assert seed.first().added_date == dt.date(2001, 2, 3)
    raw = companies(spark, ("AAA", None, "Gas", 1), ("BBB", None, "", 1))
    rows = by(enrich_from_seed(stg_company_info(raw), seed), "ticker")
    assert (rows[("AAA",)]["sector"], rows[("AAA",)]["industry"]) == ("Energy", "Gas")
    assert (rows[("BBB",)]["sector"], rows[("BBB",)]["industry"]) == ("Unknown",) * 2


def test_shaping(spark):
    df = spark.createDataFrame([(1, 2)], ["Stock Splits", "Close"])
    out = shaping.stamp(shaping.normalize_columns(df), "2024-01-05", ticker="AAA")
    assert out.columns == ["stock_splits", "close", "ticker", "extracted_at"]
    both = shaping.concat_by_name([out, out.drop("close")])
    assert [r.close for r in both.orderBy(F.col("close").desc()).collect()] == [2, None]


def test_history_cut(spark):
    df = bars(spark, [1.0] * 10)
    start, end = dt.date(2024, 1, 3), dt.date(2024, 1, 6)
    assert shaping.restrict_history(df, "date", start, end).count() == 3
    assert shaping.restrict_history(df, "date", end=dt.date(2024, 1, 6), days=2).count() == 2
    assert shaping.restrict_history(df).count() == 0


@pytest.mark.parametrize(
    "gaps, frequency",
    [
        ([], "unknown"), ([1, 1, 3], "daily"), ([7, 7], "weekly"), ([31, 28], "monthly"),
        ([90, 92], "quarterly"), ([365], "annual"), ([1, 2], "daily"), ([0, 0, 9], "daily"),
    ],
)
def test_frequency(spark, gaps, frequency):
    dates = [dt.date(2020, 1, 1)]
    for gap in gaps:
        dates.append(dates[-1] + dt.timedelta(days=gap))
    rows = observations(spark, *[("S", d, 1.0) for d in dates])
    assert shaping.infer_frequency(rows).first().frequency == frequency


def test_freshness(spark):
    df = bars(spark, [1.0])  # loaded 2024-01-05
    for hours, status in ((25, "pass"), (26, "warn"), (50, "error")):
        now = dt.datetime(2024, 1, 5) + dt.timedelta(hours=hours)
        row = quality.freshness(df, now=now).first()
        assert (row.status, row.age_hours) == (status, hours)
    assert quality.freshness(df.limit(0)).first().status == "error"


def test_schema_check(spark):
    good = bars(spark, [1.0])
    assert quality.check_schema(good, schemas.PRICES).isEmpty()
    bad = good.withColumn("volume", F.lit("many")).drop("open")
    rows = by(quality.check_schema(bad, schemas.PRICES), "column_name")
    assert rows[("volume",)]["misfits"] == 1
    assert rows[("open",)]["actual_type"] is None
    assert len(rows) == 2


def test_full_run(spark, raw_dir):
    for _ in range(2):
        marts = build_marts(spark, raw_dir, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert {n: df.count() for n, df in marts.items()} == {
        "fct_daily_trading": 5, "dim_company": 1, "dim_date": 31,
    }
    marts = build_marts(
        spark, raw_dir, dt.date(2024, 1, 1), dt.date(2024, 2, 1),
        fact_partition="trading_date",
    )
    assert marts["fct_daily_trading"].count() == 5
    assert marts["fct_daily_trading"].filter("trading_date = '2024-01-02'").count() == 2
    orphans = quality.tickers_in_dim(marts["fct_daily_trading"], marts["dim_company"])
    assert [r.ticker for r in orphans.collect()] == ["MSFT"]


def test_full_run_without_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        build_marts(spark, str(tmp_path))


def test_new_files_are_merged_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    Path(source).mkdir()

    def land(df, name):
        df.coalesce(1).write.parquet(str(tmp_path / f"tmp_{name}"))
        part = next((tmp_path / f"tmp_{name}").glob("part-*"))
        (Path(source) / f"{name}_prices.parquet").write_bytes(part.read_bytes())

    def run():
        query = ingest_new_files(spark, source, target, state)
        query.awaitTermination()
        return by(read_ingested(spark, target), "ticker", "date")

    land(bars(spark, [1.0, 2.0], "AAA"), "a")
    assert len(run()) == 2
    assert len(run()) == 2
    later = bars(spark, [9.0], "AAA").withColumn("extracted_at", F.lit("2024-02-01"))
    land(later, "b")
    land(bars(spark, [5.0], "BBB", start=dt.date(2024, 3, 1)), "c")
    rows = run()
    closes = {(k[0], k[1].date()): r["close"] for k, r in rows.items()}
    assert closes == {
        ("AAA", dt.date(2024, 1, 1)): 9.0,
        ("AAA", dt.date(2024, 1, 2)): 2.0,
        ("BBB", dt.date(2024, 3, 1)): 5.0,
    }
    stale = bars(spark, [7.0], "AAA").withColumn("extracted_at", F.lit("2023-12-01"))
    land(stale, "d")
    assert run()[("AAA", dt.datetime(2024, 1, 1))]["close"] == 9.0


def test_declared_tests_are_all_there(spark, raw_dir):
    assert sum(map(len, NOT_NULL.values())) == 35
    assert sum(map(len, UNIQUE.values())) == 12
    marts = build_marts(spark, raw_dir, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    stg = {"stg_company_info": spark.table("stg_company_info")}
    rows = by(data_tests(marts | stg), "check_name")
    assert len(rows) == 7 + 4 + 1 + 1 + 2
    assert rows[("fct_tickers_in_dim_company",)]["violations"] == 1
    assert all(r["passed"] for k, r in rows.items() if "tickers_in" not in k[0])


def test_files_of_different_types_read_as_one(spark, tmp_path):
    whole = bars(spark, [1.0, 2.0], "AAA")
    gaps = bars(spark, [3.0], "BBB").withColumn("volume", F.col("volume").cast("double"))
    less = bars(spark, [4.0], "CCC").drop("volume")
    for name, df in (("AAA", whole), ("BBB", gaps), ("CCC", less)):
        df.write.parquet(str(tmp_path / f"{name}_prices.parquet"))
    rows = readers.read_prices(spark, str(tmp_path))
    assert rows.schema["volume"].dataType.simpleString() == "bigint"
    got = sorted((r.ticker, r.close, r.volume) for r in rows.filter("ticker <> 'CCC'").collect())
    assert got == [("AAA", 1.0, 100), ("AAA", 2.0, 101), ("BBB", 3.0, 100)]
    assert [r.volume for r in rows.filter("ticker = 'CCC'").collect()] == [None]


def test_a_missing_close_stored_as_nan_is_dropped(spark):
    df = bars(spark, [1.0, float("nan"), 3.0], "AAA")
    staged = stg_stock_prices(df)
    assert column(staged, "close_price") == [1.0, 3.0]
    assert column(daily_signals(staged), "prev_close_price") == [None, 1.0]


def test_macro_history_runs_through_its_end(spark):
    days = [(day(k),) for k in range(6)]
    df = spark.createDataFrame(days, "observation_date date")
    got = shaping.restrict_history(df, "observation_date", day(1), day(4), through_end=True)
    assert got.count() == 4
    assert shaping.restrict_history(df, "observation_date", day(1), day(4)).count() == 3


def test_bars_without_a_date_and_equal_loads(spark, tmp_path):
    target = str(tmp_path / "out")
    dated = bars(spark, [5.0], "AAA")
    undated = bars(spark, [1.0], "BBB").withColumn("date", F.lit(None).cast("timestamp_ntz"))
    merge_prices(dated.unionByName(undated), "s-000000000001", target)
    assert read_ingested(spark, target).count() == 2
    # loaded at the same time, in a later batch, at a lower price
    merge_prices(bars(spark, [4.0], "AAA"), "s-000000000002", target)
    closes = {r.ticker: r.close for r in read_ingested(spark, target).collect()}
    assert closes == {"AAA": 4.0, "BBB": 1.0}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    january = bars(spark, [1.0, 2.0], "AAA")
    merge_prices(january, "a", target)
    february = bars(spark, [3.0], "AAA", start=dt.date(2024, 2, 1))
    for _ in range(2):
        merge_prices(february, "b", target)
    closes = sorted(r.close for r in read_ingested(spark, target).collect())
    assert closes == [1.0, 2.0, 3.0]
    # A month lost on the way comes back when its batch runs again.
    shutil.rmtree(f"{target}/current/month=2024-02")
    assert read_ingested(spark, target).count() == 2
    merge_prices(february, "b", target)
    assert read_ingested(spark, target).count() == 3


def test_a_fact_in_buckets_is_read_without_a_shuffle(spark, raw_dir):
    days = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    plain = build_marts(spark, raw_dir, *days)["fct_daily_trading"].collect()
    fact = build_marts(spark, raw_dir, *days, fact_buckets=4)["fct_daily_trading"]
    assert sorted(fact.collect(), key=str) == sorted(plain, key=str)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    months = fact.groupBy("ticker", F.trunc("trading_date", "MM")).count()
    for df in (performance.drawdown_series(fact), performance.max_drawdown_by_ticker(performance.drawdown_series(fact)), months):
        assert "Exchange" not in plan(df)
    # the order of the report alone moves rows
    assert plan(reports.monthly_returns(fact)).count("Exchange") == 1
    with pytest.raises(ValueError):
        build_marts(spark, raw_dir, *days, fact_partition="ticker", fact_buckets=4)


def test_a_fact_by_day_reads_the_files_of_the_latest_day(spark, raw_dir):
    days = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    fact = build_marts(spark, raw_dir, *days, fact_partition="trading_date")["fct_daily_trading"]
    rows = reports.on_latest_date(fact)
    assert rows.count() < fact.count()
    rows = rows.select("ticker", "close_price")
    rows.collect()
    nodes, files = [rows._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            files.append(node.metrics().apply("numFiles").value())
        if node.nodeName().endswith("QueryStage"):
            nodes.append(node.plan())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert files == [len({Path(f) for f in fact.inputFiles() if f"trading_date={latest_day(fact)}" in f})]


def latest_day(fact):
    return fact.agg(F.max("trading_date")).first()[0]
