"""DuckDB oracle SQL for every registered query that SQL can express.

The prelude derives the raw sources from the driver's test tables exactly as
``sources.testdata`` does, then Silver and Gold; each key's SQL continues it.
Column names match the Spark results.  Orders are not compared (the checker
sorts), so ``ORDER BY`` appears only where it defines a top-k.
"""

from __future__ import annotations

PRELUDE = """
WITH raw_t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         'M_' || CAST(l_suppkey AS VARCHAR) AS merchant_id,
         CAST(l_partkey % 50 AS INTEGER) AS merchant_category_id,
         CAST(l_partkey % 10 AS INTEGER) AS subsector_id,
         CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS authorized_flag,
         CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_linenumber - 1 AS INTEGER) END AS installments,
         CAST(-(l_linenumber % 13) AS INTEGER) AS month_lag,
         l_extendedprice AS purchase_amount,
         CASE WHEN c_nationkey = 24 THEN NULL ELSE c_nationkey END AS city_id,
         n_regionkey AS state_id,
         CASE WHEN l_returnflag = 'N' AND l_quantity >= 49 THEN NULL
              WHEN l_returnflag = 'N' AND l_quantity = 48 THEN '  '
              ELSE ' ' || l_returnflag END AS category,
         CASE WHEN l_quantity = 47 AND l_linenumber = 7 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate
                     + to_hours(CAST(CASE WHEN l_linenumber = 1 THEN 0 ELSE l_partkey % 24 END AS INTEGER))
                     + to_minutes(CAST(l_orderkey % 60 AS INTEGER)), '%Y-%m-%d %H:%M:%S') END AS purchase_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey),
base AS (
  SELECT s_suppkey AS k,
         CASE WHEN s_suppkey % 5 = 0 THEN 'Chain Store' ELSE ' ' || s_name || ' ' END AS merchant_name,
         'M_' || CAST(s_suppkey AS VARCHAR) AS merchant_id,
         CAST(s_nationkey AS VARCHAR) AS merchant_group_id,
         CAST(s_suppkey % 50 AS VARCHAR) AS merchant_category_id,
         CAST(s_suppkey % 10 AS VARCHAR) AS subsector_id,
         chr(CAST(65 + s_suppkey % 5 AS INTEGER)) AS most_recent_sales_range,
         chr(CAST(65 + s_suppkey % 3 AS INTEGER)) AS most_recent_purchases_range,
         CAST(s_nationkey AS VARCHAR) AS city_id,
         CAST(n_regionkey AS VARCHAR) AS state_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE s_suppkey % 10 <> 3),
raw_m AS (
  SELECT * EXCLUDE k FROM base
  UNION ALL SELECT merchant_name || ' DUP', merchant_id,
         CAST(CAST(merchant_group_id AS INTEGER) + 100 AS VARCHAR),
         * EXCLUDE (k, merchant_name, merchant_id, merchant_group_id) FROM base WHERE k % 7 = 0
  UNION ALL SELECT merchant_name || ' DUP', merchant_id,
         CASE WHEN k % 2 = 0 THEN '' ELSE 'inf' END,
         * EXCLUDE (k, merchant_name, merchant_id, merchant_group_id) FROM base WHERE k % 7 = 1),
sm AS (
  SELECT * EXCLUDE rn FROM (
    SELECT merchant_id, trim(merchant_name) AS merchant_name,
           TRY_CAST(merchant_group_id AS INTEGER) AS merchant_group_id,
           TRY_CAST(merchant_category_id AS INTEGER) AS merchant_category_id,
           TRY_CAST(subsector_id AS INTEGER) AS subsector_id,
           most_recent_sales_range, most_recent_purchases_range,
           TRY_CAST(city_id AS INTEGER) AS city_id, TRY_CAST(state_id AS INTEGER) AS state_id,
           row_number() OVER (PARTITION BY merchant_id
             ORDER BY TRY_CAST(merchant_group_id AS INTEGER) NULLS LAST,
                      TRY_CAST(city_id AS INTEGER) NULLS LAST,
                      TRY_CAST(merchant_category_id AS INTEGER) NULLS LAST,
                      TRY_CAST(state_id AS INTEGER) NULLS LAST,
                      trim(merchant_name) NULLS LAST) AS rn
    FROM raw_m) WHERE rn = 1),
st0 AS (SELECT *, TRY_STRPTIME(purchase_date, '%Y-%m-%d %H:%M:%S') AS ts FROM raw_t),
st AS (
  SELECT customer_id, merchant_id, merchant_category_id, subsector_id, authorized_flag,
         installments, month_lag, purchase_amount, city_id, state_id,
         CASE WHEN category IS NULL OR trim(category) = '' THEN 'Unknown category'
              ELSE trim(category) END AS category,
         ts AS purchase_ts,
         CAST(year(ts) AS INTEGER) AS txn_year, CAST(month(ts) AS INTEGER) AS txn_month_num,
         CAST(year(ts) * 100 + month(ts) AS INTEGER) AS txn_month_key,
         strftime(ts, '%b %Y') AS txn_month_label,
         CAST(hour(ts) AS INTEGER) AS txn_hour,
         lpad(CAST(hour(ts) * 100 AS VARCHAR), 4, '0') AS txn_hour_label
  FROM st0),
gold AS (
  SELECT st.customer_id, st.merchant_id, coalesce(sm.merchant_name, st.merchant_id) AS merchant_name,
         st.category, st.purchase_amount, st.installments, st.authorized_flag, st.city_id, st.state_id,
         st.merchant_category_id, st.subsector_id, st.month_lag, st.purchase_ts, st.txn_year,
         st.txn_month_num, st.txn_month_key, st.txn_month_label, st.txn_hour, st.txn_hour_label,
         sm.merchant_group_id, sm.most_recent_sales_range, sm.most_recent_purchases_range,
         sm.city_id AS merchant_city_id, sm.state_id AS merchant_state_id
  FROM st LEFT JOIN sm ON st.merchant_id = sm.merchant_id)
"""

_MONEY = "CAST(sum(CAST(purchase_amount AS DECIMAL(38,10))) AS DOUBLE)"
_MEAN = f"{_MONEY} / count(purchase_amount)"
_PF = (
    "CASE WHEN installments IS NULL OR installments <= 1 THEN 0.25::DOUBLE "
    "ELSE round(0.25::DOUBLE - 0.5::DOUBLE * (1.0::DOUBLE - pow(0.771::DOUBLE, installments)), 12) END"
)
_PF_FLAT = (
    "CASE WHEN installments IS NULL OR installments <= 1 THEN 0.25::DOUBLE "
    "ELSE round(0.25::DOUBLE - 0.5::DOUBLE * 0.229::DOUBLE, 12) END"
)
_Q1 = (
    "SELECT txn_month_label AS month, city_id AS city, merchant_name AS merchant, purchase_total, "
    "no_of_sales, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY txn_month_key, city_id "
    "ORDER BY purchase_total DESC, merchant_name) AS INTEGER) AS rank FROM (SELECT txn_month_key, "
    f"txn_month_label, city_id, merchant_name, {_MONEY} AS purchase_total, count(*) AS no_of_sales "
    "FROM gold GROUP BY 1, 2, 3, 4)) WHERE rank <= 5"
)

BODIES: dict[str, str] = {
    "bronze_merchants": (
        "SELECT merchant_name, merchant_id, nullif(merchant_group_id, '') AS merchant_group_id, "
        "merchant_category_id, subsector_id, NULL::VARCHAR AS numerical_1, NULL::VARCHAR AS numerical_2, most_recent_sales_range, "
        "most_recent_purchases_range, "
        + ", ".join(f"NULL::VARCHAR AS {m}_lag{k}" for k in (3, 6, 12) for m in ("avg_sales", "avg_purchases", "active_months"))
        + ", city_id, state_id FROM raw_m"
    ),
    "bronze_transactions": "SELECT * FROM raw_t",
    "silver_merchants": "SELECT * FROM sm",
    "silver_transactions": "SELECT * FROM st",
    "gold_enriched": "SELECT * FROM gold",
    # written to tables (batch layers) or a streaming sink, then read back
    "layer_round_trip": "SELECT * FROM gold",
    "gold_incremental": "SELECT * FROM gold",
    "top_merchants_by_city_month": _Q1,
    "top_merchants_slice": (
        f"SELECT * FROM ({_Q1}) WHERE month IN ('Oct 1997', 'Nov 1997') AND city IN (2, 3)"
    ),
    "avg_sale_by_merchant_state": (
        f"SELECT merchant_name AS merchant, state_id, {_MEAN} AS average_amount, "
        "count(*) AS no_of_sales FROM gold GROUP BY 1, 2"
    ),
    "avg_sale_robust_top_per_state": (
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY state_id ORDER BY "
        "average_amount DESC, merchant_name) AS INTEGER) AS rank_in_state FROM (SELECT merchant_name, "
        f"state_id, {_MEAN} AS average_amount, count(*) AS n FROM gold GROUP BY 1, 2) "
        "WHERE n >= 100) WHERE rank_in_state = 1"
    ),
    "avg_sale_robust_top_per_state_500": (
        "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY state_id ORDER BY "
        "average_amount DESC, merchant_name) AS INTEGER) AS rank_in_state FROM (SELECT merchant_name, "
        f"state_id, {_MEAN} AS average_amount, count(*) AS n FROM gold GROUP BY 1, 2) "
        "WHERE n >= 500) WHERE rank_in_state = 1"
    ),
    "top_hours_by_category": (
        "SELECT category AS product_category, txn_hour_label AS hour, purchase_total, rank FROM "
        "(SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY purchase_total DESC, "
        "txn_hour NULLS FIRST) AS INTEGER) AS rank FROM (SELECT category, txn_hour, txn_hour_label, "
        f"{_MONEY} AS purchase_total FROM gold GROUP BY 1, 2, 3)) WHERE rank <= 3"
    ),
    "popular_merchants": (
        "SELECT merchant_name AS merchant, total_sales, city_id AS primary_city_id, city_sales AS "
        "sales_in_primary_city FROM (SELECT *, CAST(sum(city_sales) OVER (PARTITION BY merchant_name) "
        "AS BIGINT) AS total_sales, row_number() OVER (PARTITION BY merchant_name ORDER BY city_sales "
        "DESC, city_id NULLS FIRST) AS rn FROM (SELECT merchant_name, city_id, count(*) AS city_sales "
        "FROM gold GROUP BY 1, 2)) WHERE rn = 1 AND merchant_name IS NOT NULL "
        "ORDER BY total_sales DESC, merchant LIMIT 20"
    ),
    "city_category_contingency": (
        "SELECT city_id, category, count(*) AS n FROM gold GROUP BY city_id, category"
    ),
    "cramers_v": (
        "SELECT n, r, k, round(n * (phi1 - 1), 6) AS chi2, "
        "round(sqrt(greatest(phi1 - 1, 0) / least(r - 1, k - 1)), 9) AS cramers_v FROM ("
        "SELECT any_value(nn) AS n, count(DISTINCT city_id) AS r, count(DISTINCT category) AS k, "
        "sum(o * o / (ri * cj)) AS phi1 FROM (SELECT *, sum(o) OVER (PARTITION BY city_id) AS ri, "
        "sum(o) OVER (PARTITION BY category) AS cj, sum(o) OVER () AS nn FROM ("
        "SELECT city_id, category, CAST(count(*) AS DOUBLE) AS o FROM gold "
        "WHERE city_id IS NOT NULL GROUP BY city_id, category)))"
    ),
    "category_mix_top_cities": (
        "SELECT c.city_id, c.category, c.n, t.t, round(100.0::DOUBLE * c.n / t.t, 1) AS pct FROM "
        "(SELECT city_id, category, count(*) AS n FROM gold WHERE city_id IN (SELECT city_id FROM "
        "(SELECT city_id FROM gold GROUP BY 1 ORDER BY count(*) DESC, city_id NULLS FIRST LIMIT 6) "
        "WHERE city_id IS NOT NULL) GROUP BY 1, 2) c JOIN (SELECT city_id, count(*) AS t FROM gold "
        "WHERE city_id IN (SELECT city_id FROM (SELECT city_id FROM gold GROUP BY 1 ORDER BY "
        "count(*) DESC, city_id NULLS FIRST LIMIT 6) WHERE city_id IS NOT NULL) GROUP BY 1) t "
        "ON c.city_id = t.city_id"
    ),
    "dominant_category_by_city": (
        "SELECT city_id, category, n, pct FROM (SELECT *, round(100.0::DOUBLE * n / "
        "CAST(sum(n) OVER (PARTITION BY city_id) AS BIGINT), 1) AS pct, row_number() OVER "
        "(PARTITION BY city_id ORDER BY n DESC, category) AS rn FROM (SELECT city_id, category, "
        "count(*) AS n FROM gold GROUP BY 1, 2)) WHERE rn = 1"
    ),
    "city_scorecard": (
        f"SELECT city_id, {_MONEY} AS revenue, count(*) AS txns, round({_MEAN}, 2) AS avg_ticket "
        "FROM gold GROUP BY 1"
    ),
    "preview_city_scorecard": (
        f"SELECT city_id, {_MONEY} AS revenue, count(*) AS txns, round({_MEAN}, 2) AS avg_ticket "
        "FROM gold GROUP BY 1 ORDER BY revenue DESC, city_id NULLS FIRST LIMIT 10"
    ),
    "category_scorecard": (
        f"SELECT category, {_MONEY} AS revenue, count(*) AS txns, round({_MEAN}, 2) AS avg_ticket "
        "FROM gold GROUP BY 1"
    ),
    "monthly_seasonality": (
        f"SELECT txn_month_key, txn_month_label, {_MONEY} AS revenue, count(*) AS txns "
        "FROM gold GROUP BY 1, 2"
    ),
    "hourly_curve": f"SELECT txn_hour, {_MONEY} AS revenue, count(*) AS txns FROM gold GROUP BY 1",
    "installment_profit": (
        "SELECT *, round(profit_factor * revenue, 0) AS expected_profit, "
        "round(0.25::DOUBLE * revenue, 0) AS cash_profit FROM (SELECT installments, "
        f"{_MONEY} AS revenue, count(*) AS txns, {_PF} AS profit_factor FROM gold GROUP BY installments)"
    ),
    "installment_profit_flat": (
        "SELECT *, round(profit_factor * revenue, 0) AS expected_profit, "
        "round(0.25::DOUBLE * revenue, 0) AS cash_profit FROM (SELECT installments, "
        f"{_MONEY} AS revenue, count(*) AS txns, {_PF_FLAT} AS profit_factor FROM gold "
        "GROUP BY installments)"
    ),
    "installment_schedule": (
        "SELECT installments, CASE WHEN installments <= 1 THEN 0.0::DOUBLE ELSE round(1.0::DOUBLE - "
        f"pow(0.771::DOUBLE, installments), 12) END AS p_default, {_PF} AS profit_factor, "
        f"CASE WHEN installments <= 1 THEN 'full margin' WHEN {_PF} > 0 THEN 'marginal' "
        f"WHEN {_PF} > -0.1 THEN 'loss' WHEN {_PF} > -0.2 THEN 'heavy loss' "
        "ELSE 'near-total loss' END AS verdict "
        "FROM (SELECT DISTINCT installments FROM gold WHERE installments IS NOT NULL)"
    ),
    "revenue_share_by_category": (
        "SELECT category, CAST(d AS DOUBLE) AS revenue, round(CAST(d AS DOUBLE) / "
        "CAST(sum(d) OVER () AS DOUBLE), 9) AS share FROM (SELECT category, "
        "sum(CAST(purchase_amount AS DECIMAL(38,10))) AS d FROM gold GROUP BY 1)"
    ),
    "top_city_share": (
        "SELECT city_id, n, round(CAST(sum(n) OVER (ORDER BY n DESC, city_id NULLS FIRST ROWS "
        "UNBOUNDED PRECEDING) AS DOUBLE) / (SELECT count(*) FROM gold), 9) AS running_share FROM "
        "(SELECT city_id, count(*) AS n FROM gold GROUP BY 1 ORDER BY n DESC, city_id NULLS FIRST "
        "LIMIT 5)"
    ),
    "peak_month": (
        f"SELECT txn_month_key, txn_month_label, {_MONEY} AS revenue, count(*) AS txns FROM gold "
        "GROUP BY 1, 2 ORDER BY revenue DESC, txn_month_key LIMIT 1"
    ),
    "core_hours_share": (
        "SELECT round(CAST(count(*) FILTER (WHERE txn_hour BETWEEN 11 AND 20) AS DOUBLE) / count(*), "
        "9) AS core_share FROM gold WHERE txn_hour <> 0"
    ),
    "midnight_share": (
        "SELECT count(*) AS n, count(*) FILTER (WHERE hour(purchase_ts) = 0 AND minute(purchase_ts) "
        "= 0 AND second(purchase_ts) = 0) AS midnight_n FROM gold"
    ),
    "layer_row_counts": (
        "SELECT 'bronze.merchants' AS layer_table, count(*) AS row_count FROM raw_m UNION ALL "
        "SELECT 'silver.merchants', count(*) FROM sm UNION ALL SELECT 'bronze.transactions', "
        "count(*) FROM raw_t UNION ALL SELECT 'silver.transactions', count(*) FROM st UNION ALL "
        "SELECT 'gold.transactions_enriched', count(*) FROM gold"
    ),
    "merchant_key_uniqueness": (
        "SELECT count(*) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT merchant_id FROM sm)) "
        "AS distinct_ids FROM sm"
    ),
    "name_fallback_audit": (
        "SELECT merchant_name <> merchant_id AS is_named, count(*) AS n FROM gold GROUP BY 1"
    ),
    "distinct_profile": (
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT city_id FROM gold)) AS cities, "
        "(SELECT count(*) FROM (SELECT DISTINCT state_id FROM gold)) AS states, "
        "(SELECT count(*) FROM (SELECT DISTINCT category FROM gold)) AS categories"
    ),
    "month_profile": (
        "SELECT txn_month_key, txn_month_label, count(*) AS n FROM gold GROUP BY 1, 2"
    ),
    "category_profile": f"SELECT category, count(*) AS n, {_MONEY} AS total FROM gold GROUP BY 1",
    "city_volume_topn": (
        "SELECT city_id, count(*) AS n FROM gold GROUP BY 1 ORDER BY n DESC, city_id NULLS FIRST "
        "LIMIT 15"
    ),
    "join_fanout_check": (
        "SELECT (SELECT count(*) FROM st) AS silver_rows, (SELECT count(*) FROM gold) AS gold_rows"
    ),
    "written_fanout_check": (
        "SELECT (SELECT count(*) FROM st) AS silver_rows, count(*) AS gold_rows, "
        "count(*) FILTER (WHERE merchant_name <> merchant_id) AS named, "
        "count(*) FILTER (WHERE merchant_name = merchant_id) AS unnamed FROM gold"
    ),
    "sales_rollup": (
        "SELECT txn_month_key, city_id, state_id, merchant_name, category, txn_hour, "
        f"{_MONEY} AS purchase_total, count(*) AS no_of_sales FROM gold GROUP BY 1, 2, 3, 4, 5, 6"
    ),
    "merchant_evidence": (
        "SELECT city_id, category, txn_month_key, txn_hour, installments, CASE WHEN grouping(city_id) = 0 THEN 'city_id' "
        "WHEN grouping(category) = 0 THEN 'category' WHEN grouping(txn_month_key) = 0 THEN 'txn_month_key' "
        "WHEN grouping(txn_hour) = 0 THEN 'txn_hour' ELSE 'installments' END AS part, "
        f"{_MONEY} AS revenue, count(*) AS txns, round({_MEAN}, 2) AS avg_ticket FROM gold GROUP BY GROUPING SETS "
        "((city_id), (category), (txn_month_key), (txn_hour), (installments))"
    ),
    "amount_scale_check": (
        "SELECT count(*) AS n, count(*) FILTER (WHERE purchase_amount IS NULL) AS null_amounts, "
        "count(*) FILTER (WHERE purchase_amount IS NOT NULL AND NOT (abs(purchase_amount) < 134217728 "
        "AND abs(purchase_amount - round(purchase_amount, 8)) <= abs(purchase_amount) * pow(2, -51))) AS out_of_scale FROM gold"
    ),
}


# The same answers from a rollup's states.
for _key in ("top_merchants_by_city_month", "avg_sale_by_merchant_state", "top_hours_by_category", "popular_merchants"):
    BODIES[f"{_key}_from_rollup"] = BODIES[_key]
BODIES["distinct_profile_from_states"] = BODIES["distinct_profile"]


def oracle_sql() -> dict[str, str]:
    """Full DuckDB statements: prelude + body, per key."""
    return {key: PRELUDE + body for key, body in BODIES.items()}
