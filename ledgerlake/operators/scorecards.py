"""Evidence for a new merchant: scorecards, seasonality, hours, installments.

All are one aggregate over Gold (partial + final), plus a sort of the small
result.  Report orders put the group key last so they are total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import DEFAULT_PROFIT_MODEL, ProfitModel, money_mean, money_sum, month_label_of, profit_factor


def _revenue_txns():
    return [
        money_sum(F.col("purchase_amount")).alias("revenue"),
        F.count(F.lit(1)).alias("txns"),
    ]


def _scorecard(gold: DataFrame, key: str) -> DataFrame:
    return (
        gold.groupBy(key)
        .agg(*_revenue_txns(), F.round(money_mean(F.col("purchase_amount")), 2).alias("avg_ticket"))
        .orderBy(F.col("revenue").desc(), F.col(key))
    )


def city_scorecard(gold: DataFrame) -> DataFrame:
    """Revenue, transactions and average ticket per city, by revenue."""
    return _scorecard(gold, "city_id")


def category_scorecard(gold: DataFrame) -> DataFrame:
    """Revenue, transactions and average ticket per category, by revenue."""
    return _scorecard(gold, "category")


def monthly_seasonality(gold: DataFrame) -> DataFrame:
    """Revenue and transactions per calendar month, in month order."""
    return (
        gold.groupBy("txn_month_key")
        .agg(*_revenue_txns())
        .select("txn_month_key", month_label_of(F.col("txn_month_key")).alias("txn_month_label"), "revenue", "txns")
        .orderBy("txn_month_key")
    )


def hourly_curve(gold: DataFrame) -> DataFrame:
    """Revenue and transactions per hour of day (hour 0 holds date-only rows)."""
    return gold.groupBy("txn_hour").agg(*_revenue_txns()).orderBy("txn_hour")


def installment_profit(gold: DataFrame, model: ProfitModel = DEFAULT_PROFIT_MODEL) -> DataFrame:
    """Revenue, transactions and modelled profit per installment count.

    ``profit_factor`` comes from ``model`` (a native expression, no UDF);
    ``expected_profit`` = factor × revenue and ``cash_profit`` = margin ×
    revenue, both rounded to whole units.
    """
    per_plan = gold.groupBy("installments").agg(*_revenue_txns())
    factors = {"expected_profit": profit_factor(F.col("installments"), model), "cash_profit": F.lit(float(model.margin))}
    profits = [F.round(factor * F.col("revenue"), 0).alias(name) for name, factor in factors.items()]
    return per_plan.select("*", factors["expected_profit"].alias("profit_factor"), *profits).orderBy("installments")
