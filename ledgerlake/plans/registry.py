"""Named queries: one entry per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame built
from the driver's test tables through the raw-source adapters, so every query
reads the whole tables and its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from .. import operators as ops
from ..functions import ProfitModel
from ..sources.testdata import raw_merchants, raw_transactions
from ..sources.tables import T_BRONZE_MERCHANTS, T_BRONZE_TRANSACTIONS
from .layers import bronze_table, gold_incremental, layer_round_trip, written_fanout_check, written_row_counts

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
Q1_TOP_N = 5
Q3_TOP_N = 3
Q4_TOP_N = 20
SLICE_MONTHS = ("Oct 1997", "Nov 1997")
SLICE_CITIES = (2, 3)
# 500 sales is the published support threshold; at the small test scales
# only one merged name reaches it, so a second key uses 100.
ROBUST_MIN_SALES = 500
ROBUST_MIN_SALES_SMALL = 100
MIX_TOP_CITIES = 6
TOP_SHARE_CITIES = 5
CITY_VOLUME_TOP = 15
PREVIEW_ROWS = 10
FLAT_MODEL = ProfitModel(compounding=False)


def silver_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_merchants(raw_merchants(spark, sf_dir))


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_transactions(raw_transactions(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.build_gold(silver_transactions(spark, sf_dir), silver_merchants(spark, sf_dir))


def preview_city_scorecard(gold: DataFrame) -> DataFrame:
    """The bounded preview of a report: its first rows, in report order."""
    return ops.preview(ops.city_scorecard(gold), PREVIEW_ROWS)


def _on_gold(key: str) -> Query:
    op = GOLD_OPS[key]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(gold(spark, sf_dir))

    query.__name__ = key
    return query


def merchant_key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.merchant_key_uniqueness(silver_merchants(spark, sf_dir))


def join_fanout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = silver_transactions(spark, sf_dir)
    return ops.join_fanout_check(st, ops.build_gold(st, silver_merchants(spark, sf_dir)))


# Operators over the Gold table, with the registered parameters.
GOLD_OPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    # questions
    "top_merchants_by_city_month": partial(ops.q1_top_merchants_by_city_month, n=Q1_TOP_N),
    "top_merchants_slice": partial(ops.q1_slice, months=SLICE_MONTHS, cities=SLICE_CITIES, n=Q1_TOP_N),
    "avg_sale_by_merchant_state": ops.q2_avg_sale_by_merchant_state,
    "avg_sale_robust_top_per_state": partial(ops.q2_robust_top_per_state, min_sales=ROBUST_MIN_SALES_SMALL),
    "avg_sale_robust_top_per_state_500": partial(ops.q2_robust_top_per_state, min_sales=ROBUST_MIN_SALES),
    "top_hours_by_category": partial(ops.q3_top_hours_by_category, n=Q3_TOP_N),
    "popular_merchants": partial(ops.q4_popular_merchants, n=Q4_TOP_N),
    # association
    "city_category_contingency": partial(ops.contingency, a="city_id", b="category"),
    "cramers_v": partial(ops.cramers_v, a="city_id", b="category"),
    "category_mix_top_cities": partial(ops.category_mix_top_cities, top=MIX_TOP_CITIES),
    "dominant_category_by_city": ops.dominant_category_by_city,
    # new-merchant evidence
    "city_scorecard": ops.city_scorecard,
    "category_scorecard": ops.category_scorecard,
    "monthly_seasonality": ops.monthly_seasonality,
    "hourly_curve": ops.hourly_curve,
    "installment_profit": ops.installment_profit,
    "installment_profit_flat": partial(ops.installment_profit, model=FLAT_MODEL),
    "installment_schedule": ops.installment_schedule,
    "merchant_evidence": ops.merchant_evidence,
    # mergeable states, and the questions asked of them
    "sales_rollup": lambda gold: ops.rollup_totals(ops.sales_rollup(gold)),
    "top_merchants_by_city_month_from_rollup": lambda gold: ops.q1_top_merchants_by_city_month(ops.sales_rollup(gold), n=Q1_TOP_N),
    "avg_sale_by_merchant_state_from_rollup": lambda gold: ops.q2_avg_sale_by_merchant_state(ops.sales_rollup(gold)),
    "top_hours_by_category_from_rollup": lambda gold: ops.q3_top_hours_by_category(ops.sales_rollup(gold), n=Q3_TOP_N),
    "popular_merchants_from_rollup": lambda gold: ops.q4_popular_merchants(ops.sales_rollup(gold), n=Q4_TOP_N),
    "distinct_profile_from_states": lambda gold: ops.distinct_profile_of(ops.distinct_states(gold)),
    # published figures
    "revenue_share_by_category": ops.revenue_share_by_category,
    "top_city_share": partial(ops.top_city_share, k=TOP_SHARE_CITIES),
    "peak_month": ops.peak_month,
    "core_hours_share": ops.core_hours_share,
    "midnight_share": ops.midnight_share,
    # data quality on Gold
    "name_fallback_audit": ops.name_fallback_audit,
    "distinct_profile": ops.distinct_profile,
    "month_profile": ops.month_profile,
    "category_profile": ops.category_profile,
    "city_volume_topn": partial(ops.city_volume_topn, n=CITY_VOLUME_TOP),
    "amount_scale_check": ops.amount_scale_check,
    # a report as a notebook shows it
    "preview_city_scorecard": preview_city_scorecard,
}

QUERIES: dict[str, Query] = {
    # sources and layers
    "bronze_merchants": partial(bronze_table, table=T_BRONZE_MERCHANTS),
    "bronze_transactions": partial(bronze_table, table=T_BRONZE_TRANSACTIONS),
    "silver_merchants": silver_merchants,
    "silver_transactions": silver_transactions,
    "gold_enriched": gold,
    "layer_round_trip": layer_round_trip,
    "gold_incremental": gold_incremental,
    # operators over Gold
    **{key: _on_gold(key) for key in GOLD_OPS},
    # reconciliation across layers
    "layer_row_counts": written_row_counts,
    "merchant_key_uniqueness": merchant_key_uniqueness,
    "join_fanout_check": join_fanout_check,
    "written_fanout_check": written_fanout_check,
}
