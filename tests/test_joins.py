"""Size-checked broadcast: broadcast under the limit, sort-merge beyond it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from helpers import merchant, merchants, txn, txns

from ledgerlake.operators import build_gold, clean_merchants, clean_transactions
from ledgerlake.operators.joins import broadcast_if_small, measured_bytes


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_measured_bytes_is_exact_unsafe_row_size(spark):
    df = spark.createDataFrame([("abc", 1), ("", 2), (None, 3), ("123456789", 4)], "s string, i int")
    # per row: 8 (null bits) + 2 * 8 (slots) + string padded to 8 bytes
    assert measured_bytes(df) == 4 * 24 + 8 + 0 + 0 + 16


def _gold_plan(spark, limit):
    t = clean_transactions(txns(spark, [txn("M1", 1.0), txn("M2", 2.0)]))
    m = clean_merchants(merchants(spark, [merchant("M1"), merchant("M2")]))
    g = build_gold(t, m, broadcast_max_bytes=limit)
    assert g.count() == 2
    return g._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_broadcast_even_without_spark_threshold(spark, no_auto_broadcast):
    plan = _gold_plan(spark, 1 << 20)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_side_over_the_limit_falls_back_to_sort_merge(spark, no_auto_broadcast):
    plan = _gold_plan(spark, 1)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_limit_zero_leaves_the_choice_to_spark(spark):
    df = spark.range(3)
    same, chosen = broadcast_if_small(df, 0)
    assert same is df and chosen is False


def test_salted_join_equals_plain_join_with_a_hot_key(spark, no_auto_broadcast):
    rows = [txn("HOT", float(i), customer=f"C{i}") for i in range(200)] + [
        txn("M2", 5.0), txn("ORPHAN", 1.0), txn(None, 2.0)
    ]
    t = clean_transactions(txns(spark, rows))
    m = clean_merchants(merchants(spark, [merchant("HOT"), merchant("M2")]))
    plain = build_gold(t, m)
    salted = build_gold(t, m, salt_buckets=8)
    assert salted.count() == plain.count() == 203
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "__salt" in plan
    # the hot key's rows are spread over several salt values
    from ledgerlake.operators.cleaning import SALT_COLUMNS
    salts = t.filter("merchant_id = 'HOT'").select(
        F.pmod(F.xxhash64(*SALT_COLUMNS), F.lit(8)).alias("s")
    ).distinct().count()
    assert salts == 8
