"""Test data folders and builders of raw-shaped rows (merchants: 9 text columns, transactions: 12)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

SF_SMALL = "/root/testdata/sf0.001"

MERCHANT_FIELDS = [
    "merchant_name",
    "merchant_id",
    "merchant_group_id",
    "merchant_category_id",
    "subsector_id",
    "most_recent_sales_range",
    "most_recent_purchases_range",
    "city_id",
    "state_id",
]
MERCHANT_SCHEMA = StructType([StructField(c, StringType(), True) for c in MERCHANT_FIELDS])

TXN_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), True),
        StructField("merchant_id", StringType(), True),
        StructField("merchant_category_id", LongType(), True),
        StructField("subsector_id", LongType(), True),
        StructField("authorized_flag", StringType(), True),
        StructField("installments", LongType(), True),
        StructField("month_lag", LongType(), True),
        StructField("purchase_amount", DoubleType(), True),
        StructField("city_id", LongType(), True),
        StructField("state_id", LongType(), True),
        StructField("category", StringType(), True),
        StructField("purchase_date", StringType(), True),
    ]
)


def merchants(spark, rows):
    return spark.createDataFrame(rows, MERCHANT_SCHEMA)


def txns(spark, rows):
    return spark.createDataFrame(rows, TXN_SCHEMA)


def txn(merchant, amount, city=5, state=9, category="A", date="2017-10-01 13:00:00",
        installments=1, customer="C"):
    """One raw transaction row with defaults for the columns a test ignores."""
    return (customer, merchant, 1, 1, "Y", installments, -1, amount, city, state, category, date)


def merchant(mid, name=None, group="1", city="5", state="9", category="1"):
    return (name if name is not None else f"Merch {mid}", mid, group, category, "1", "A", "A", city, state)


def gold_of(spark, txn_rows, merchant_rows):
    from ledgerlake.operators import build_gold, clean_merchants, clean_transactions

    return build_gold(
        clean_transactions(txns(spark, txn_rows)), clean_merchants(merchants(spark, merchant_rows))
    )
