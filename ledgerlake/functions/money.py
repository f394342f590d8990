"""Money aggregates that drop no row and do not depend on row order.

A plain double sum rounds differently for every order in which rows arrive, so
totals can differ in the last bits between runs and flip a ranking.  Here an
amount below 2^27 (134 million) with at most eight decimals is split into its
integer part and its decimals as a whole number; both are summed as BIGINT,
which is exact in any order, and put together as a decimal once per group.
Every other amount (±inf, NaN, larger ones, finer decimals) is added as a plain
double, so nothing is left out and non-finite amounts give what a plain sum
gives.

Range: the exact part takes an amount's nearest eight-decimal value, which up to
about 4.5e7 is the decimal it was written as; beyond, the double itself carries
less than eight decimals and its own error stays.  A part's BIGINT sum cannot
overflow below 2^36 (6.9e10) rows of one group at the largest amounts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Resolution of the exact part, as decimals and as units per whole.
MONEY_DECIMALS = 8
_UNITS = 10**MONEY_DECIMALS
_EXACT_BELOW = float(2**27)
# An amount is on the grid if eight decimals give it back to within its own rounding.
_ROUNDING = 2.0**-51


def _split(c: Column) -> tuple[Column, Column, Column]:
    """Of the amount without its sign: integer part, decimals in units, and whether both together are it."""
    x = F.abs(c.cast("double"))
    whole = F.floor(x)
    units = F.floor((x - whole) * _UNITS + 0.5)
    gap = F.abs(x - (whole.cast("double") + units.cast("double") / _UNITS))
    return whole, units, (x < _EXACT_BELOW) & (gap <= x * _ROUNDING)


def money_parts(c: Column) -> dict[str, Column]:
    """The aggregates of a sum, by part; parts of several groups add up to those of all."""
    whole, units, exact = _split(c)
    signed = lambda part: F.sum(F.when(exact, F.when(c < 0, -part).otherwise(part)))
    return {"whole": signed(whole), "units": signed(units), "rest": F.sum(F.when(~exact, c.cast("double")))}


def money_value(parts: dict[str, Column]) -> Column:
    """The total that :func:`money_parts` aggregates stand for, as double; no amounts → NULL."""
    whole = parts["whole"].cast("decimal(19,0)")
    units = parts["units"].cast("decimal(19,0)") * F.lit("0.00000001").cast("decimal(8,8)")
    exact = (whole + units).cast("double")
    return F.coalesce(exact + parts["rest"], exact, parts["rest"])


def money_sum(c: Column) -> Column:
    """Sum of amounts as double: exact for eight decimals, order-independent there."""
    return money_value(money_parts(c))


def money_mean(c: Column) -> Column:
    """Mean of non-NULL amounts: :func:`money_sum` ÷ ``count(c)``; no rows → NULL."""
    return F.try_divide(money_sum(c), F.count(c).cast("double"))


def money_off_grid(c: Column) -> Column:
    """Count of non-NULL amounts that are added as plain doubles."""
    _, _, exact = _split(c)
    return F.count(F.when(c.isNotNull() & ~exact, F.lit(1)))
