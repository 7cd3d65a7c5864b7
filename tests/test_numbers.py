import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeline.functions import finance, labels
from tapeline.functions.numbers import (
    exact_avg,
    ratio,
    rnd,
    rnd_sql,
    steady_avg,
    steady_stddev,
    ticks,
)
from tapeline.operators.performance import cagr_by_ticker


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def half_away(x, digits):
    scaled = x * 10.0**digits
    return math.copysign(math.floor(abs(scaled) + 0.5), scaled) / 10.0**digits


def test_rounding_goes_away_from_zero(spark):
    values = [0.5, -0.5, 1.5, 2.5, -2.5, 0.00015, 1.00005, 0.0, -0.3, 1e9 + 0.5]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 2, 4):
        got = rows.select(
            rnd(F.col("v"), digits).alias("a"), F.expr(rnd_sql("v", digits)).alias("b")
        ).collect()
        want = [half_away(v, digits) for v in values]
        assert [r.a for r in got] == want
        assert [r.b for r in got] == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=200))
def test_rounding_of_any_number(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.a for r in rows.select(rnd(F.col("v"), 4).alias("a")).collect()]
    whole = [abs(v * 1e4) >= 2.0**52 for v in values]
    assert got == [v if w else half_away(v, 4) for v, w in zip(values, whole)]


def test_rounding_keeps_null(spark):
    assert one(spark, rnd(F.lit(None).cast("double"), 4)) is None


def test_ratio_by_zero_is_null(spark):
    assert one(spark, ratio(F.lit(1.0), F.lit(0.0))) is None


def test_average_does_not_depend_on_order(spark):
    values = [(v / 10000,) for v in range(1, 4000, 7)]
    up = spark.createDataFrame(values, "v double").repartition(7)
    down = spark.createDataFrame(values[::-1], "v double").coalesce(1)
    a, b = (df.agg(exact_avg(F.col("v")).alias("x")).first().x for df in (up, down))
    assert a == b


@pytest.mark.parametrize("digits", [0, 2, 4, 6])
def test_numbers_without_digits_to_round_come_back(spark, digits):
    values = [1e15, -1e15, 1e20, 1.7e308, float("inf"), float("-inf"), 2.0**52, 5e-324]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(
        "v", rnd(F.col("v"), digits).alias("a"), F.expr(rnd_sql("v", digits)).alias("b")
    ).collect()
    for r in got:
        assert r.a == r.b == (0.0 if r.v < 1e-300 and r.v > 0 else r.v)
    nan = spark.sql("SELECT double('NaN') AS v").select(rnd(F.col("v"), digits).alias("x")).first().x
    assert nan != nan


def test_ticks_of_what_no_whole_number_holds(spark):
    df = spark.createDataFrame([(float("nan"),), (1e300,), (1.5,)], "v double")
    assert [r[0] for r in df.select(ticks(F.col("v"))).collect()] == [None, None, 15000]


def test_growth_over_two_days(spark):
    rows = [("A", dt.date(2024, 1, 1), 100.0), ("A", dt.date(2024, 1, 2), 115.0)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, close_price double")
    assert cagr_by_ticker(df).first().cagr == pytest.approx(1.15**365.25 - 1)


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_deviation_and_mean_do_not_depend_on_the_layout(spark, parts):
    values = [((k * 7919 % 100_003) / 10_000 - 5,) for k in range(5_000)]
    df = spark.createDataFrame(values, "v double").repartition(parts)
    mean, risk = df.agg(steady_avg(F.col("v")), steady_stddev(F.col("v"))).first()
    exact = [round(v[0] * 10_000) for v in values]
    n, total, squares = len(exact), sum(exact), sum(t * t for t in exact)
    assert risk == math.sqrt((squares - total * total / n) / (n - 1)) / 10_000
    assert mean == pytest.approx(total / n / 10_000, abs=1e-11)


def test_finance_formulas(spark):
    lit = F.lit
    assert one(spark, finance.pct_change(lit(110), lit(100))) == 10.0
    assert one(spark, finance.pct_change(lit(110), lit(0))) is None
    assert one(spark, finance.cagr(lit(100), lit(121), lit(2))) == pytest.approx(0.1)
    assert one(spark, finance.cagr(lit(0), lit(121), lit(2))) is None
    assert one(spark, finance.cagr(lit(100), lit(121), lit(0))) is None
    assert one(spark, finance.sharpe(lit(10.0), lit(4.0), lit(12.0))) == 0.5
    assert one(spark, finance.sharpe(lit(10.0), lit(4.0), lit(0.0))) is None
    assert one(spark, finance.log_return(lit(-1.0), lit(2.0))) is None


def test_keys_and_labels(spark):
    a, b = F.lit("A"), F.lit(None).cast("string")
    assert one(spark, labels.surrogate_key(a, F.lit("2024-01-02"))) == one(
        spark, F.md5(F.lit("A-2024-01-02"))
    )
    assert one(spark, labels.surrogate_key(a, b)) == one(
        spark, F.md5(F.lit("A-_dbt_utils_surrogate_key_null_"))
    )
    caps = [10**12, 2 * 10**11, 10**10, 2 * 10**9, 2 * 10**9 - 1, None]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(caps)], "i int, c bigint")
    names = [
        r.x
        for r in rows.orderBy("i").select(
            labels.market_cap_category(F.col("c")).alias("x")
        ).collect()
    ]
    assert [n.split()[0] for n in names] == [
        "Mega", "Large", "Mid", "Small", "Micro", "Unknown",
    ]
    for rate, name in [(5.0, "High"), (3.0, "Elevated"), (1.0, "Normal"), (0.9, "Low")]:
        assert one(spark, labels.rate_regime(F.lit(rate))).startswith(name)


@pytest.mark.parametrize(
    "values, mean",
    [
        ([1e15, 1.0], 5e14 + 0.5),
        ([1e15] * 20_000, 1e15),
        ([1e25, 1.0], 5e24),
        ([float("inf"), 1.0], float("inf")),
        ([float("nan"), 3.0, None], 3.0),
        ([None], None),
    ],
)
def test_averages_count_what_they_add_up(spark, values, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact_avg(F.col("v"))).first()[0] == mean
    assert df.agg(steady_avg(F.col("v"))).first()[0] == mean
