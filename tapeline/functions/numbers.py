"""Rounding, exact sums and guarded division.

Results are rounded to four decimals and then averaged and rounded again, so a
sum that depends on row order can flip a last digit from run to run.  Sums over
rounded values therefore run on whole numbers (ten-thousandths), which add up
the same in any order and on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stored prices, returns and volatilities carry four decimals.
SCALE = 10_000
#: Of a four-decimal value whose sums must not overflow.
MONEY = "decimal(28,4)"
#: Doubles from here on are whole numbers.
WHOLE = float(2**52)


def rnd(x: Column, digits: int) -> Column:
    """Round half away from zero on the scaled binary value.

    ``F.round`` on a double goes through the decimal text of the number, which
    is slower and disagrees with the usual scale-round-unscale in the last digit.
    A scaled value of 2**52 or more has no digits left to round: such numbers,
    infinities and NaN come back as they are.  The expression is kept short on
    purpose: a projection with many roundings must stay within the size up to
    which the JVM compiles a method.
    """
    unit = F.lit(float(10**digits))
    scaled = x * unit
    rounded = F.signum(scaled) * F.floor(F.abs(scaled) + 0.5) / unit
    return F.when(F.abs(scaled) < WHOLE, rounded).otherwise(x)


def rnd_sql(x: str, digits: int) -> str:
    """``rnd`` of a SQL expression, as SQL."""
    unit = f"{float(10**digits)}D"
    return (
        f"IF(abs(({x}) * {unit}) < {WHOLE}D,"
        f" signum(({x}) * {unit}) * floor(abs(({x}) * {unit}) + 0.5D) / {unit}, ({x}))"
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, on a zero denominator."""
    return F.try_divide(numerator, denominator)


def ticks(x: Column, scale: int = SCALE) -> Column:
    """A four-decimal double as a whole number of ten-thousandths; NULL, like a
    missing value, for NaN and for what no such number holds (9.2e14 and more)."""
    return F.rint(x * F.lit(float(scale))).try_cast("bigint")


def unticks(x: Column) -> Column:
    return x / F.lit(float(SCALE))


def present(x: Column) -> Column:
    """A double, with NULL for NaN."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def steady_avg(x: Column) -> Column:
    """Aggregate: mean of any double, independent of row order.

    Values add up as decimals of twelve places; NaN counts as missing.  If a value
    is beyond 1e18 the plain mean of doubles is given."""
    d, v = x.try_cast("decimal(30,12)"), present(x)
    return F.when(F.count(d) == F.count(v), F.avg(d).cast("double")).otherwise(F.avg(v))


def steady_stddev(x: Column, scale: int = SCALE) -> Column:
    """Aggregate: sample deviation of a double of so many decimals, independent of
    row order, from whole-number sums.  NULL for fewer than two values."""
    t = ticks(x, scale).cast("decimal(18,0)")
    n = F.count(t)
    total, squares = F.sum(t).cast("double"), F.sum(t * t).cast("double")
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return F.sqrt(ratio(spread, F.when(n > 1, n - 1))) / F.lit(float(scale))


def exact_avg(x: Column) -> Column:
    """Aggregate: mean of a four-decimal double, independent of row order.

    NaN counts as missing.  If a value fits no decimal (1e24 and more) the plain mean
    of doubles is given."""
    d, v = x.try_cast(MONEY), present(x)
    exact = ratio(F.sum(d).cast("double"), F.count(d))
    return F.when(F.count(d) == F.count(v), exact).otherwise(F.avg(v))
