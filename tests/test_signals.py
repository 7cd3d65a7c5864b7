import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from frames import bars, by, column, companies, day, observations
from tapeline.operators import macro, performance, quality, series, signals, staging
from tapeline.operators.staging import stg_stock_prices
from tapeline.plans import marts
from tapeline.sources.shaping import concat_by_name


def signals_of(spark, closes, **kw):
    return signals.daily_signals(stg_stock_prices(bars(spark, closes, **kw)))


def test_staging_drops_unusable_bars(spark):
    raw = bars(spark, [10.0, None, 12.0, 13.0])
    raw = raw.withColumn(
        "volume",
        F.when(F.dayofmonth("date") == 3, 0)
        .when(F.dayofmonth("date") == 4, None)
        .otherwise(F.col("volume")),
    )
    assert column(stg_stock_prices(raw), "close_price") == [10.0]


def test_staging_with_zero_open(spark):
    raw = bars(spark, [10.0]).withColumn("open", F.lit(0.0))
    assert column(stg_stock_prices(raw), "intraday_return_pct") == [None]


def test_first_row_has_no_lag(spark):
    first = signals_of(spark, [10.0, 11.0]).orderBy("trading_date").first()
    for name in (
        "prev_close_price", "daily_return_pct", "log_return_pct", "overnight_gap_pct",
        "relative_volume_20d", "volatility_20d_annualized", "price_position_52w",
    ):
        assert first[name] is None
    assert first["sma_200d"] == 10.0


def test_returns_by_hand(spark):
    df = signals_of(spark, [100.0, 110.0, 99.0])
    assert column(df, "daily_return_pct") == [None, 10.0, -10.0]
    assert column(df, "log_return_pct") == [None, 9.531, -10.5361]


def test_previous_close_of_zero(spark):
    df = signals_of(spark, [0.0, 5.0, 6.0])
    assert column(df, "daily_return_pct") == [None, None, 20.0]
    assert column(df, "log_return_pct") == [None, None, 18.2322]


def test_averages_over_fewer_rows_than_the_frame(spark):
    assert column(signals_of(spark, [1.0, 2.0, 6.0]), "sma_7d") == [1.0, 1.5, 3.0]


def test_relative_volume_leaves_today_out(spark):
    df = signals_of(spark, [10.0] * 3, volume=100)  # volumes 100, 101, 102
    assert column(df, "relative_volume_20d") == [None, 1.01, 1.01]


def test_flat_range_has_no_position(spark):
    assert column(signals_of(spark, [5.0] * 4), "price_position_52w") == [None] * 4


def test_all_frames_against_brute_force(spark):
    rng = random.Random(7)
    closes = [round(rng.uniform(50, 150), 4) for _ in range(600)]
    rows = [
        r.asDict() for r in signals_of(spark, closes).orderBy("trading_date").collect()
    ]
    logs = [r["log_return_pct"] for r in rows]
    volumes = [r["volume"] for r in rows]
    for i, row in enumerate(rows):
        def last(values, n):
            return [v for v in values[max(0, i - n + 1) : i + 1] if v is not None]

        for n in (7, 30, 90, 200):
            window = last(closes, n)
            mean = sum(round(c * 10000) for c in window) / 10000 / len(window)
            assert row[f"sma_{n}d"] == pytest.approx(mean, abs=5.1e-5)
        for n in (20, 90):
            assert row[f"avg_volume_{n}d"] == pytest.approx(
                statistics.mean(last(volumes, n)), abs=0.51
            )
        for n in (20, 60):
            window = last(logs, n)
            if len(window) > 1:
                deviation = statistics.stdev(v / 100 for v in window)
                assert row[f"volatility_{n}d_annualized"] == pytest.approx(
                    deviation * 252**0.5 * 100, abs=5.1e-5
                )
            else:
                assert row[f"volatility_{n}d_annualized"] is None
        assert row["high_52w"] == max(last(closes, 252))
        assert row["low_52w"] == min(last(closes, 252))


def random_bars(spark):
    rng = random.Random(3)
    frames = []
    for ticker, n in (("HOT", 1500), ("MID", 400), ("TINY", 3)):
        closes = [round(rng.uniform(1, 99), 4) for _ in range(n)]
        frames.append(bars(spark, closes, ticker, start=dt.date(2015, 1, 1)))
    return stg_stock_prices(concat_by_name(frames))


def test_cut_series_give_the_same_signals(spark):
    stg = random_bars(spark)
    whole = signals.daily_signals(stg)
    cut = signals.daily_signals(stg, slice_rows=300)
    assert sorted(cut.columns) == sorted(whole.columns)
    assert by(cut, "price_id") == by(whole, "price_id")
    assert cut.count() == stg.count()


def test_cut_copes_with_uneven_days(spark):
    """Several rows on one day, more than a slice holds."""
    stg = random_bars(spark)
    heavy = stg.filter("ticker = 'HOT' AND trading_date = DATE'2016-03-01'")
    many = heavy.crossJoin(spark.range(400)).drop("id")
    rows = stg.unionByName(many)
    cut = series.cut_long_series(rows, reach=252, rows=300)
    own = cut.filter(~F.col("is_lead"))
    assert own.count() == rows.count()
    # Every slice has the reach in front of it, or starts the series.
    ranked = rows.filter("ticker = 'HOT'")
    for part in {r.slice_no for r in own.filter("ticker = 'HOT'").collect()} - {0}:
        mine = cut.filter((F.col("ticker") == "HOT") & (F.col("slice_no") == part))
        start = mine.filter(~F.col("is_lead")).agg(F.min("trading_date")).first()[0]
        before = ranked.filter(F.col("trading_date") < start).count()
        leads = mine.filter("is_lead AND trading_date < DATE'%s'" % start).count()
        assert leads >= min(252, before)


def test_cut_gaps_are_the_same(spark):
    stg = random_bars(spark).filter("dayofmonth(trading_date) % 5 <> 0")
    whole = by(quality.no_large_date_gaps(stg, days=1), "price_id")
    cut = quality.no_large_date_gaps(stg, days=1, slice_rows=100)
    assert by(cut, "price_id") == whole
    assert len(whole) > 100


def test_cut_drawdown_gives_the_same(spark):
    stg = random_bars(spark)
    key = ("ticker", "trading_date")
    whole, cut = (by(performance.drawdown_series(stg, c), *key) for c in (False, True))
    assert whole == cut


def test_drawdown_by_hand(spark):
    falls = performance.drawdown_series(stg_stock_prices(bars(spark, [4.0, 5.0, 3.0, 6.0])))
    assert column(falls, "drawdown") == [0.0, 0.0, -0.4, 0.0]
    worst = performance.max_drawdown_by_ticker(falls).collect()
    assert [(r.ticker, r.max_drawdown) for r in worst] == [("AAA", -0.4)]


def test_weekend_observation_is_lost_by_fill_and_kept_as_of(spark):
    monday, sunday = dt.date(2024, 1, 8), dt.date(2024, 1, 7)
    stg = stg_stock_prices(bars(spark, [1.0, 2.0, 3.0], start=monday))
    seen = staging.stg_economic_indicators(
        observations(
            spark, ("FEDFUNDS", sunday, 5.25), ("DGS10", monday, 4.0),
            ("T10YIE", day(1, monday), 2.5),
        )
    )
    fill = macro.int_macro_context(stg, seen)
    asof = macro.asof_macro_context(stg, seen)
    assert column(fill, "fed_funds_rate", "calendar_date") == [None] * 3
    assert column(asof, "fed_funds_rate", "calendar_date") == [5.25] * 3
    assert column(fill, "treasury_yield_10y", "calendar_date") == [4.0] * 3
    assert column(fill, "real_yield_10y", "calendar_date") == [None, 1.5, 1.5]


def test_repeated_observations_take_the_largest(spark):
    monday = dt.date(2024, 1, 8)
    stg = stg_stock_prices(bars(spark, [1.0], start=monday))
    seen = observations(spark, ("CPIAUCSL", monday, 1.0), ("CPIAUCSL", monday, 2.0))
    assert column(macro.int_macro_context(stg, seen), "cpi", "calendar_date") == [2.0]


def test_missing_values_are_no_observations(spark):
    monday = dt.date(2024, 1, 8)
    seen = observations(
        spark, ("CPIAUCSL", monday, float("nan")), ("UNRATE", monday, None),
        ("FEDFUNDS", None, 1.0), ("DGS10", monday, 1.0),
    )
    assert column(staging.stg_economic_indicators(seen), "series_id", "value") == ["DGS10"]


def test_company_defaults(spark):
    raw = companies(spark, ("A", "", None, 1), ("B", None, "Tools", None))
    plain = by(staging.stg_company_info(raw), "ticker")
    assert plain[("A",)]["sector"] == ""
    assert plain[("A",)]["industry"] == "Unknown"
    assert plain[("B",)]["sector"] == "Unknown"
    assert plain[("B",)]["currency"] == "USD"
    blank = by(staging.stg_company_info(raw, blank_as_null=True), "ticker")
    assert blank[("A",)]["sector"] == "Unknown"


def test_fact_keeps_bars_without_company_or_macro(spark):
    stg = stg_stock_prices(bars(spark, [1.0, 2.0]))
    about = staging.stg_company_info(companies(spark, ("ZZZ", "S", "I", 1)))
    fact = marts.fct_daily_trading(stg, about, observations(spark))
    assert fact.columns == marts.FACT and len(fact.columns) == 33
    rows = fact.collect()
    assert len(rows) == 2
    assert {(r.sector, r.cpi) for r in rows} == {(None, None)}


def test_default_calendar(spark):
    dates = marts.dim_date(stg_stock_prices(bars(spark, [1.0])), as_of=dt.date(2024, 1, 1))
    assert dates.count() == 2922
    assert len(dates.columns) == 20
    row = dates.filter("is_trading_day").first()
    assert row.calendar_date == dt.date(2024, 1, 1)
    assert (row.day_of_week, row.day_name, row.fiscal_quarter_label) == (
        1, "Monday", "2024-Q1",
    )
    assert (row.is_today, row.is_current_year, row.is_current_month) == (True,) * 3


def test_moving_averages_of_large_closes(spark):
    rows = signals_of(spark, [1e15, 1.0, *[2.0] * 9, 1e30, 3.0]).orderBy("trading_date").collect()
    assert [r.sma_7d for r in rows[:2]] == [1e15, 5e14 + 0.5]
    assert rows[1].sma_200d == 5e14 + 0.5
    assert [r.sma_7d for r in rows[8:]] == [2.0, 2.0, 2.0, None, None]
    assert rows[10].sma_200d == pytest.approx((1e15 + 19) / 11, rel=1e-15)


def lucky_bars(spark, tickers, n, seed=1):
    luck = random.Random(seed)
    parts = []
    for t in tickers:
        start = dt.date(2020, 1, 1) + dt.timedelta(days=luck.randint(0, 400))
        closes = [luck.choice([None, 1.0, 50.0, round(luck.uniform(1, 100), 2)]) for _ in range(n)]
        parts.append(bars(spark, closes, t, start=start))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return stg_stock_prices(out)


def test_range_of_a_year_by_blocks(spark):
    """Ties, series shorter than a block, of whole blocks and across them."""
    rows = lucky_bars(spark, ["A", "B"], 800).unionByName(lucky_bars(spark, ["C"], 300, 2))
    got = signals.daily_signals(rows.unionByName(rows.filter("ticker = 'A' AND trading_date > '2022-01-01'")))
    closes = {}
    for r in got.orderBy("ticker", "trading_date").collect():
        frame = closes.setdefault(r.ticker, [])
        frame.append(r.close_price)
        assert (r.high_52w, r.low_52w) == (max(frame[-252:]), min(frame[-252:]))
    assert {len(c) > 252 for c in closes.values()} == {True, False}


def test_range_needs_no_sliding_frame(spark):
    plan = signals.int_moving_averages(lucky_bars(spark, ["A"], 3))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "specifiedwindowframe(RowFrame, unboundedpreceding$(), currentrow$())" in text
    assert not [f for f in ("RowFrame, -35", "RowFrame, -251") if f in text]
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_trailing_signals_are_those_of_the_whole(spark):
    rows = lucky_bars(spark, ["A", "B", "C"], 1500)
    since = rows.agg(F.date_sub(F.max("trading_date"), 365)).first()[0]
    whole = signals.daily_signals(rows).filter(F.col("trading_date") >= since)
    assert sorted(signals.trailing_signals(rows).collect()) == sorted(whole.collect())
    used = ["ticker", "trading_date", "daily_return_pct", "volatility_20d_annualized"]
    short = signals.trailing_signals(rows, reach=20).select(used)
    assert sorted(short.collect(), key=str) == sorted(whole.select(used).collect(), key=str)


def test_rows_into_the_windows_do_not_grow_with_the_years(spark):
    def kept(n):
        return signals.trailing_bars(lucky_bars(spark, ["A", "B"], n))

    assert 500 < kept(1200).count() < 2 * (366 + 252)
    assert 500 < kept(2400).count() < 2 * (366 + 252)
    plan = kept(1200)._jdf.queryExecution().executedPlan().toString()
    # each task keeps the last bars before the year before they are shuffled
    assert "WindowGroupLimit" in plan and "Partial" in plan
