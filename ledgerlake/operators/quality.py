"""Data-quality and reconciliation reports, each a DataFrame (no printing).

Every report is a single aggregate pass per table it reads.  Distinct counts
are exact and count NULL as a value, like ``select(c).distinct().count()``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money_sum, month_label_of
from ..functions.money import money_off_grid


def _distinct_with_null(c: str) -> Column:
    has_null = F.max(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0)))
    return (F.count_distinct(F.col(c)) + F.coalesce(has_null, F.lit(0))).cast("long")


def layer_row_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """One row per layer table: (layer_table, row_count)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("layer_table"), "row_count"
        )
        for name, df in layers.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merchant_key_uniqueness(merchants: DataFrame, key: str = "merchant_id") -> DataFrame:
    """Rows vs distinct keys (NULL counted once): equal when the key is unique."""
    return merchants.agg(
        F.count(F.lit(1)).alias("row_count"),
        _distinct_with_null(key).alias("distinct_ids"),
    )


def name_fallback_audit(gold: DataFrame) -> DataFrame:
    """Rows whose name is a real name (true), the id stand-in (false) or NULL."""
    return (
        gold.groupBy((F.col("merchant_name") != F.col("merchant_id")).alias("is_named"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("is_named")
    )


def distinct_profile(gold: DataFrame) -> DataFrame:
    """Distinct cities, states and categories (NULL counted as a value)."""
    return gold.agg(
        _distinct_with_null("city_id").alias("cities"),
        _distinct_with_null("state_id").alias("states"),
        _distinct_with_null("category").alias("categories"),
    )


def month_profile(gold: DataFrame) -> DataFrame:
    """Rows per calendar month, in month order."""
    return (
        gold.groupBy("txn_month_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("txn_month_key", month_label_of(F.col("txn_month_key")).alias("txn_month_label"), "n")
        .orderBy("txn_month_key")
    )


def category_profile(gold: DataFrame) -> DataFrame:
    """Rows and revenue per category, most rows first."""
    return (
        gold.groupBy("category")
        .agg(F.count(F.lit(1)).alias("n"), money_sum(F.col("purchase_amount")).alias("total"))
        .orderBy(F.col("n").desc(), F.col("category"))
    )


def city_volume_topn(gold: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` cities with most transactions (ties: lowest id, NULL first)."""
    return (
        gold.groupBy("city_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("city_id").asc_nulls_first())
        .limit(n)
    )


def join_fanout_check(silver_transactions: DataFrame, gold: DataFrame) -> DataFrame:
    """Silver vs Gold row counts; equal when the merchant join did not fan out."""
    gold_rows = gold.select(F.count(F.lit(1))).scalar()
    return silver_transactions.agg(F.count(F.lit(1)).alias("silver_rows")).select(
        "silver_rows", gold_rows.alias("gold_rows")
    )


def amount_scale_check(gold: DataFrame) -> DataFrame:
    """Rows, NULL amounts, and amounts that money sums add as plain doubles."""
    amt = F.col("purchase_amount")
    return gold.agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(amt.isNull(), F.lit(1))).alias("null_amounts"),
        money_off_grid(amt).alias("out_of_scale"),
    )
