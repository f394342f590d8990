"""Operators: ``DataFrame -> DataFrame`` functions, all lazy."""

from .association import category_mix_top_cities, contingency, cramers_v, cramers_v_of_cells, dominant_category_by_city
from .cleaning import build_gold, build_gold_bucketed, changed_merchants, clean_merchants, clean_transactions, hot_merchants
from .quality import (
    amount_scale_check,
    category_profile,
    city_volume_topn,
    distinct_profile,
    join_fanout_check,
    layer_row_counts,
    merchant_key_uniqueness,
    month_profile,
    name_fallback_audit,
)
from .questions import (
    q1_slice,
    q1_top_merchants_by_city_month,
    q2_avg_sale_by_merchant_state,
    q2_robust_top_per_state,
    q3_top_hours_by_category,
    q4_popular_merchants,
)
from .joins import broadcast_if_small, measured_bytes
from .ranking import first_per_key, preview, top_n_per_group
from .reports import (
    core_hours_share,
    installment_schedule,
    midnight_share,
    peak_month,
    revenue_share_by_category,
    top_city_share,
)
from .rollup import (
    distinct_profile_of,
    distinct_states,
    evidence_report,
    measures,
    merchant_evidence,
    merge_distinct_states,
    merge_rollups,
    rollup_totals,
    sales_rollup,
)
from .scorecards import (
    category_scorecard,
    city_scorecard,
    hourly_curve,
    installment_profit,
    monthly_seasonality,
)

__all__ = [name for name in dir() if not name.startswith("_")]
