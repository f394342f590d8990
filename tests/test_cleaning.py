"""Silver cleaning and the Gold join."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from helpers import gold_of, merchant, merchants, txn, txns
from pyspark.sql import functions as F

from ledgerlake.functions import UNKNOWN_CATEGORY
from ledgerlake.operators import build_gold, clean_merchants, clean_transactions
from ledgerlake.sources.schemas import GOLD_COLUMNS, SILVER_MERCHANT_COLUMNS, SILVER_TRANSACTION_COLUMNS

CALENDAR = ("purchase_ts", "txn_year", "txn_month_num", "txn_month_key", "txn_month_label", "txn_hour", "txn_hour_label")


def test_the_row_that_stays_is_the_smallest_whatever_the_order(spark, ansi):
    """Group, then city, then category; what does not parse comes last."""
    ansi(True)
    ranked = [
        merchant("dup", " first ", group=" -4", city="60", category="8"),
        merchant("dup", "later category", group="-4.0", city="60", category="9"),
        merchant("dup", "later city", group="-4", city="61", category="0"),
        merchant("dup", "no city", group="-4", city="n/a", category="0"),
        merchant("dup", "later group", group="31", city="1", category="0"),
        merchant("dup", "no group", group="inf", city="0", category="0"),
    ]
    for k, order in enumerate(itertools.islice(itertools.permutations(ranked), 0, 720, 180)):
        out = clean_merchants(merchants(spark, [*order, merchant("single", "no group either", group="-")]).repartition(1 + k))
        assert out.columns == SILVER_MERCHANT_COLUMNS
        rows = {r.merchant_id: r for r in out.collect()}
        assert len(rows) == out.count() == 2
        assert (rows["dup"].merchant_name, rows["dup"].merchant_group_id, rows["dup"].city_id) == ("first", -4, 60)
        assert rows["single"].merchant_group_id is None


def test_types_of_silver_merchants(spark):
    out = clean_merchants(merchants(spark, [merchant("t")]))
    numbers = {"merchant_group_id", "merchant_category_id", "subsector_id", "city_id", "state_id"}
    assert {name for name, kind in out.dtypes if kind == "int"} == numbers
    assert {name for name, kind in out.dtypes if kind == "string"} == set(SILVER_MERCHANT_COLUMNS) - numbers


@pytest.mark.parametrize("raw, clean", [(None, UNKNOWN_CATEGORY), ("   ", UNKNOWN_CATEGORY), (" garden ", "garden"), ("\t", "\t")])
def test_category(spark, raw, clean):
    out = clean_transactions(txns(spark, [txn("m", 3.25, category=raw)]))
    assert out.columns == SILVER_TRANSACTION_COLUMNS
    assert [r.category for r in out.collect()] == [clean]


@pytest.mark.parametrize("text, want", [
    ("2016-02-29 23:59:58", (dt.datetime(2016, 2, 29, 23, 59, 58), 2016, 2, 201602, "Feb 2016", 23, "2300")),
    ("2019-12-01 00:00:00", (dt.datetime(2019, 12, 1), 2019, 12, 201912, "Dec 2019", 0, "0000")),
    ("2019-02-29 10:00:00", (None,) * 7),
    ("2019-12-01", (None,) * 7),
    (None, (None,) * 7),
])
def test_calendar_columns(spark, ansi, text, want):
    ansi(True)
    row = clean_transactions(txns(spark, [txn("m", 1.5, date=text)])).first()
    assert tuple(row[c] for c in CALENDAR) == want and row.purchase_amount == 1.5


def test_a_date_typed_purchase_date_is_midnight(spark):
    raw = txns(spark, [txn("m", 1.5, date="2020-08-09")]).withColumn("purchase_date", F.col("purchase_date").cast("date"))
    row = clean_transactions(raw).first()
    assert tuple(row[c] for c in CALENDAR) == (dt.datetime(2020, 8, 9), 2020, 8, 202008, "Aug 2020", 0, "0000")


def test_text_numbers_are_read_leniently(spark, ansi):
    ansi(True)
    raw = txns(spark, [txn("m", 1.0)]).select(
        *[F.lit(v).alias(c) if v is not None else F.col(c).cast("string").alias(c) for c, v in {
            "customer_id": None, "merchant_id": None, "merchant_category_id": "\t61.9\n", "subsector_id": "six",
            "authorized_flag": None, "installments": "+7", "month_lag": "-.5", "purchase_amount": " 8.125 ",
            "city_id": "99999999999", "state_id": "", "category": None, "purchase_date": None}.items()])
    row = clean_transactions(raw).first()
    assert (row.merchant_category_id, row.subsector_id, row.installments, row.month_lag) == (61, None, 7, 0)
    assert (row.purchase_amount, row.city_id, row.state_id) == (8.125, None, None)


@pytest.mark.parametrize("how", [{}, {"broadcast_max_bytes": 1 << 20}, {"broadcast_max_bytes": 1}, {"salt_buckets": 3}])
def test_gold_rows_and_names(spark, how):
    """Matched, unmatched, unnamed, empty-named and missing merchants, by every join strategy."""
    side = merchants(spark, [
        merchant("m-17", "Tannery", group="3", city="70", state="8"),
        merchant("m-17", "Tannery copy", group="5", city="70", state="8"),
        ("", "m-18", "1", "1", "1", "A", "B", "71", "8"),
        (None, "m-19", "1", "1", "1", "A", "B", "72", "8"),
        ("Nobody's", None, "1", "1", "1", "A", "B", "73", "8"),
        ("Blank id", "", "1", "1", "1", "A", "B", "74", "8"),
    ])
    sales = [txn(i, 2.0 + k, city=50 + k, state=k) for k, i in enumerate(["m-17", "m-18", "m-19", "m-99", None, None, ""])]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gold = build_gold(clean_transactions(txns(spark, sales)), clean_merchants(side), **how)
        assert gold.columns == GOLD_COLUMNS
        got = {(r.city_id, r.state_id): (r.merchant_id, r.merchant_name, r.merchant_city_id) for r in gold.collect()}
        assert gold.count() == len(sales)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [("m-17", "Tannery", 70), ("m-18", "", 71), ("m-19", "m-19", 72), ("m-99", "m-99", None),
            (None, None, None), (None, None, None), ("", "Blank id", 74)]
    assert got == {(50 + k, k): row for k, row in enumerate(want)}


def test_gold_of_no_merchants(spark):
    assert [r.merchant_name for r in gold_of(spark, [txn("m-5", 1.0)], [merchant("m-6")]).collect()] == ["m-5"]
