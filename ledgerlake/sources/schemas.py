"""Declared schemas and column lists of every layer."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Column order of the raw merchants CSV.  CSV columns bind by
# position, so this order is the contract with the file.
MERCHANT_CSV_COLUMNS = [
    "merchant_name",
    "merchant_id",
    "merchant_group_id",
    "merchant_category_id",
    "subsector_id",
    "numerical_1",
    "numerical_2",
    "most_recent_sales_range",
    "most_recent_purchases_range",
    "avg_sales_lag3",
    "avg_purchases_lag3",
    "active_months_lag3",
    "avg_sales_lag6",
    "avg_purchases_lag6",
    "active_months_lag6",
    "avg_sales_lag12",
    "avg_purchases_lag12",
    "active_months_lag12",
    "city_id",
    "state_id",
]

# Landed verbatim as text; typing is Silver's work, so no value can break the scan.
MERCHANTS_RAW_SCHEMA = StructType([StructField(name, StringType()) for name in MERCHANT_CSV_COLUMNS])

# Silver's output contracts, as column → how it is read (see
# ``operators.cleaning``).  The source column has the same name unless stated.
SILVER_MERCHANT_KINDS = {
    "merchant_id": "text",
    "merchant_name": "trimmed",
    "merchant_group_id": "int",
    "merchant_category_id": "int",
    "subsector_id": "int",
    "most_recent_sales_range": "text",
    "most_recent_purchases_range": "text",
    "city_id": "int",
    "state_id": "int",
}
SILVER_TRANSACTION_KINDS = {
    "customer_id": "text",
    "merchant_id": "text",
    "merchant_category_id": "int",
    "subsector_id": "int",
    "authorized_flag": "text",
    "installments": "int",
    "month_lag": "int",
    "purchase_amount": "amount",
    "city_id": "int",
    "state_id": "int",
    "category": "category",
    "purchase_ts": "time",
}
RENAMED_SOURCES = {"purchase_ts": "purchase_date"}

SILVER_MERCHANT_COLUMNS = list(SILVER_MERCHANT_KINDS)
SILVER_TRANSACTION_COLUMNS = [
    *SILVER_TRANSACTION_KINDS,
    "txn_year",
    "txn_month_num",
    "txn_month_key",
    "txn_month_label",
    "txn_hour",
    "txn_hour_label",
]

# What Gold takes from the merchant side, and under which name.
GOLD_FROM_MERCHANT = {
    "merchant_group_id": "merchant_group_id",
    "most_recent_sales_range": "most_recent_sales_range",
    "most_recent_purchases_range": "most_recent_purchases_range",
    "city_id": "merchant_city_id",
    "state_id": "merchant_state_id",
}

# Gold's output contract.
GOLD_COLUMNS = [
    "customer_id",
    "merchant_id",
    "merchant_name",
    "category",
    "purchase_amount",
    "installments",
    "authorized_flag",
    "city_id",
    "state_id",
    "merchant_category_id",
    "subsector_id",
    "month_lag",
    "purchase_ts",
    "txn_year",
    "txn_month_num",
    "txn_month_key",
    "txn_month_label",
    "txn_hour",
    "txn_hour_label",
    "merchant_group_id",
    "most_recent_sales_range",
    "most_recent_purchases_range",
    "merchant_city_id",
    "merchant_state_id",
]
