"""Averages and revenue figures whose last digit does not depend on the order of summation.

A sum of doubles depends on which task adds first, and so does its rounding at a tie. All figures here are computed on
decimals and handed out as doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from lettora.params import Economics, StrategyLabels

CENTS = DecimalType(20, 2)

# A double has up to 17 significant digits, and a decimal column 38. So doubles are summed in lanes by magnitude, each with
# as many places as its values have, and at least ten digits to spare for the sum: (from, up to, type).
LANES = [
    (1e-20, 1e-11, DecimalType(38, 36)),
    (1e-11, 1.0, DecimalType(28, 28)),
    (1.0, 1e11, DecimalType(28, 17)),
    (1e11, 1e22, DecimalType(28, 6)),
]
WHOLE, PART = DecimalType(38, 0), DecimalType(37, 36)


def mean(value: Column, digits: int) -> Column:
    """``round(avg(value), digits)`` without any rounding before; NULLs are skipped, ties go away from zero.

    Every value counts as the decimal that Spark writes it as (0.1 is one tenth), to its last digit. Sums are exact for 0 and
    values from 10^-20 up to 10^22, whatever their mixture, so the result does not depend on order. A group with any
    other value (NaN, infinite, larger or tinier ones), or with more rows than a sum of its size holds (10^10 and more),
    is averaged as doubles.
    """
    number, size = value.cast("double"), F.abs(value.cast("double"))
    known = (size == 0) | ((size >= LANES[0][0]) & (size < LANES[-1][1]))
    rough, sums = F.count_if(value.isNotNull() & ~known) > 0, []
    for low, high, kind in LANES:
        within = (size >= low) & (size < high)
        total = F.try_sum(F.when(within, value.try_cast(kind)))
        rough = rough | (total.isNull() & (F.count_if(within) > 0))
        sums.append(F.coalesce(total, F.lit(Decimal(0))))
    exact = _rounded_quotient(sums, F.count(value).cast(DecimalType(20, 0)), digits)
    return F.when(rough, F.round(F.avg(number), digits)).when(F.count(value) > 0, exact)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _rounded_quotient(sums: list[Column], n: Column, digits: int) -> Column:
    """The sum of ``sums`` over ``n``, rounded to ``digits``.

    Whole numbers and fractions (of up to 36 places) are added apart, and the remainder of the quotient says on which side
    of a tie it lies: no digit is ever cut off. Types are chosen so that no step needs more than 38 digits.
    """
    scale, step = F.lit(10**digits).cast(DecimalType(digits + 1, 0)), F.lit(Decimal(1).scaleb(-digits))
    zero, one = F.lit(0).cast(WHOLE), F.lit(1).cast(WHOLE)
    fractions = [(total % 1).cast(PART) for total in sums]
    wholes = [(total - total % 1).cast(WHOLE) for total in sums]
    added = F.struct(
        n.alias("n"),
        reduce(lambda a, b: (a + b).cast(WHOLE), wholes).alias("whole"),
        reduce(lambda a, b: (a + b).cast(PART), fractions).alias("part"),
    )

    def carried(v: Column) -> Column:
        """The fractions may make up whole numbers; both then get one sign, which is kept apart."""
        whole = (v["whole"] + (v["part"] - v["part"] % 1).cast(WHOLE)).cast(WHOLE)
        return _let(F.struct(whole.alias("i"), (v["part"] % 1).cast(PART).alias("f")), lambda w: signed(v, w))

    def signed(v: Column, w: Column) -> Column:
        i, f = w["i"], w["f"]
        borrow = F.when((i > 0) & (f < 0), 1).when((i < 0) & (f > 0), -1).otherwise(0)
        positive = F.struct(
            F.abs(i - borrow.cast(WHOLE)).cast(WHOLE).alias("i"),
            F.abs(f + borrow.cast(PART)).cast(PART).alias("f"),
            F.when((i < 0) | ((i == 0) & (f < 0)), -one).otherwise(one).cast(DecimalType(1, 0)).alias("sign"),
        )
        return _let(positive, lambda x: scaled(v, x))

    def scaled(v: Column, x: Column) -> Column:
        rest = (x["f"] % step).cast(PART)
        whole = (x["i"] * scale).cast(WHOLE) + ((x["f"] - rest) * scale).cast(WHOLE)
        return _let(F.struct(whole.cast(WHOLE).alias("t"), rest.alias("rest")), lambda y: divided(v, x, y))

    def divided(v: Column, x: Column, y: Column) -> Column:
        left = (y["t"] % v["n"]).cast(DecimalType(20, 0))
        quotient = ((y["t"] - left).cast(WHOLE) / v["n"]).cast(WHOLE)
        return _let(F.struct(left.alias("left"), quotient.alias("q")), lambda z: rounded(v, x, y, z))

    def rounded(v: Column, x: Column, y: Column, z: Column) -> Column:
        # What lies behind the remainder is less than one: it decides only beside the tie.
        twice, n = (z["left"] * 2).cast(WHOLE), v["n"].cast(WHOLE)
        up = F.when(twice >= n, one).when((twice == n - one) & (y["rest"] * 2 >= step), one).otherwise(zero)
        return ((z["q"] + up).cast(DecimalType(28, 0)) * step * x["sign"]).cast("double")

    return _let(added, carried)


def _cents(value: Column) -> Column:
    return value.try_cast(CENTS)


def _or_double(exact: Column, rough: Column, *values: Column) -> Column:
    """``exact`` if all values fit ``CENTS``, else ``rough``, both to two digits."""
    fits = reduce(lambda a, b: a & b, [value.isNull() | _cents(value).isNotNull() for value in values])
    return F.when(fits, F.round(exact, 2).cast("double")).otherwise(F.round(rough, 2))


def short_term_revenue(nightly_price: Column, economics: Economics) -> Column:
    """Yearly revenue from an (already rounded) nightly price."""
    nights = Decimal(economics.days_per_year) * Decimal(str(economics.occupancy_rate))
    return _or_double(_cents(nightly_price) * F.lit(nights), nightly_price * F.lit(float(nights)), nightly_price)


def long_term_revenue(monthly_rent: Column, economics: Economics) -> Column:
    """Yearly revenue from an (already rounded) monthly rent."""
    months = F.lit(economics.months_per_year)
    return _or_double(_cents(monthly_rent) * months, monthly_rent * months.cast("double"), monthly_rent)


def difference(left: Column, right: Column) -> Column:
    return _or_double(_cents(left) - _cents(right), left - right, left, right)


def ratio(left: Column, right: Column) -> Column:
    """NULL when the divisor is zero."""
    return _or_double(F.try_divide(_cents(left), _cents(right)), F.try_divide(left, right), left, right)


def strategy(advantage: Column, labels: StrategyLabels) -> Column:
    """Short-term only for a positive advantage; zero, negative and NULL mean long-term."""
    return F.when(advantage > 0, F.lit(labels.short_term)).otherwise(F.lit(labels.long_term))
