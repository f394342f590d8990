"""Figures the published findings state in prose, as operators over Gold.

Grand totals are one-row scalar subqueries (``DataFrame.scalar()``): bounded to
one value, no cross join.  The only window runs over the k rows of a top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    DEFAULT_PROFIT_MODEL,
    ProfitModel,
    default_probability,
    money_parts,
    money_value,
    profit_factor,
)
from .scorecards import monthly_seasonality

SHARE_DECIMALS = 9


def revenue_share_by_category(gold: DataFrame) -> DataFrame:
    """Revenue and its share of all revenue, per category.

    The total is a scalar subquery that adds the parts of the per-category
    sums, so it is as exact as they are and Spark reuses their shuffle.
    """
    sums = money_parts(F.col("purchase_amount"))
    per_cat = gold.groupBy("category").agg(*[part.alias(name) for name, part in sums.items()])
    revenue = money_value({name: F.col(name) for name in sums})
    total = per_cat.select(money_value({name: F.sum(name) for name in sums})).scalar()
    return per_cat.select(
        "category", revenue.alias("revenue"), F.round(F.try_divide(revenue, total), SHARE_DECIMALS).alias("share")
    ).orderBy(F.col("revenue").desc(), F.col("category"))


def top_city_share(gold: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` busiest cities and their running share of all transactions.

    The running sum is a window over the ``k`` rows left after the top-k
    (bounded by the limit); the grand total is a scalar subquery summing the
    same per-city counts, so Spark reuses their shuffle instead of counting
    Gold again.
    """
    counts = gold.groupBy("city_id").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("city_id").asc_nulls_first()]
    top = counts.orderBy(*order).limit(k)
    total = counts.select(F.sum("n").cast("double")).scalar()
    running = F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return top.select(
        "city_id",
        "n",
        F.round(running.cast("double") / total, SHARE_DECIMALS).alias("running_share"),
    ).orderBy(*order)


def peak_month(gold: DataFrame) -> DataFrame:
    """The month with the highest revenue (ties: earliest month)."""
    return (
        monthly_seasonality(gold)
        .orderBy(F.col("revenue").desc(), F.col("txn_month_key").asc())
        .limit(1)
    )


def core_hours_share(gold: DataFrame, start: int = 11, end: int = 20) -> DataFrame:
    """Share of transactions in hours ``start``–``end``, ignoring hour 0.

    Hour 0 is left out because date-only timestamps pile up there.
    """
    h = F.col("txn_hour")
    return (
        gold.filter(h != 0)
        .agg(
            F.count(F.when(h.between(start, end), F.lit(1))).alias("core_n"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            F.round(F.try_divide(F.col("core_n").cast("double"), F.col("n").cast("double")), SHARE_DECIMALS)
            .alias("core_share")
        )
    )


def midnight_share(gold: DataFrame) -> DataFrame:
    """Rows and rows stamped exactly 00:00:00 (a date-truncation signal)."""
    ts = F.col("purchase_ts")
    at_midnight = (F.hour(ts) == 0) & (F.minute(ts) == 0) & (F.second(ts) == 0)
    return gold.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(at_midnight, F.lit(1))).alias("midnight_n"),
    )


def _verdict(n, factor, model: ProfitModel):
    no_credit = n.isNull() | (n <= 1)
    # Verdict bands of the profit factor.
    return (
        F.when(no_credit, F.lit("full margin"))
        .when(factor > 0, F.lit("marginal"))
        .when(factor > -0.1, F.lit("loss"))
        .when(factor > -0.2, F.lit("heavy loss"))
        .otherwise(F.lit("near-total loss"))
    )


def installment_schedule(gold: DataFrame, model: ProfitModel = DEFAULT_PROFIT_MODEL) -> DataFrame:
    """Per installment plan seen in Gold: P(default), profit factor, verdict."""
    n = F.col("installments")
    plans = gold.filter(n.isNotNull()).select("installments").distinct()
    factor = profit_factor(n, model)
    return plans.select(
        "installments",
        default_probability(n, model).alias("p_default"),
        factor.alias("profit_factor"),
        _verdict(n, factor, model).alias("verdict"),
    ).orderBy("installments")
