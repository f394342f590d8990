"""Scorecards, published-figure reports and data-quality reports."""

from __future__ import annotations

import pytest
from helpers import gold_of, merchant, txn

from ledgerlake import operators as ops
from ledgerlake.functions import ProfitModel


@pytest.fixture()
def small_gold(spark):
    rows = [
        txn("A", 100.0, city=1, category="A", date="2017-10-01 13:00:00", installments=1),
        txn("A", 50.0, city=1, category="B", date="2017-11-02 00:00:00", installments=3),
        txn("B", 30.0, city=2, category="A", date="2017-11-03 12:30:00", installments=None),
        txn("B", 20.0, city=2, category=None, date="2017-12-04", installments=2),
        txn("C", 10.0, city=None, category="A", date="2017-12-05 21:15:00", installments=2),
    ]
    return gold_of(spark, rows, [merchant("A"), merchant("B")])


def test_city_scorecard(small_gold):
    res = [tuple(r) for r in ops.city_scorecard(small_gold).collect()]
    assert res == [(1, 150.0, 2, 75.0), (2, 50.0, 2, 25.0), (None, 10.0, 1, 10.0)]


def test_category_scorecard(small_gold):
    res = [tuple(r) for r in ops.category_scorecard(small_gold).collect()]
    assert res == [("A", 140.0, 3, 46.67), ("B", 50.0, 1, 50.0), ("Unknown category", 20.0, 1, 20.0)]


def test_monthly_and_hourly(small_gold):
    months = [tuple(r) for r in ops.monthly_seasonality(small_gold).collect()]
    assert months == [(None, None, 20.0, 1), (201710, "Oct 2017", 100.0, 1),
                      (201711, "Nov 2017", 80.0, 2), (201712, "Dec 2017", 10.0, 1)]
    hours = {r.txn_hour: r.txns for r in ops.hourly_curve(small_gold).collect()}
    assert hours == {None: 1, 0: 1, 12: 1, 13: 1, 21: 1}
    assert sum(hours.values()) == small_gold.count()


def test_installment_profit(small_gold):
    res = {r.installments: r for r in ops.installment_profit(small_gold).collect()}
    assert res[None].profit_factor == 0.25 and res[1].profit_factor == 0.25
    assert res[2].revenue == 30.0 and res[2].txns == 2
    assert res[3].expected_profit == round(50.0 * (0.25 - 0.5 * (1 - 0.771 ** 3)))
    assert res[3].cash_profit == 13.0  # 0.25 * 50 = 12.5 rounds half up


def test_installment_profit_flat_and_schedule(small_gold):
    flat = {r.installments: r.profit_factor
            for r in ops.installment_profit(small_gold, ProfitModel(compounding=False)).collect()}
    assert flat == {None: 0.25, 1: 0.25, 2: 0.1355, 3: 0.1355}
    sched = [(r.installments, r.verdict) for r in ops.installment_schedule(small_gold).collect()]
    assert sched == [(1, "full margin"), (2, "marginal"), (3, "loss")]


def test_revenue_share_sums_to_one(small_gold):
    res = ops.revenue_share_by_category(small_gold).collect()
    assert [r.category for r in res] == ["A", "B", "Unknown category"]
    assert sum(r.share for r in res) == pytest.approx(1.0)
    assert res[0].share == round(140 / 210, 9)


def test_top_city_share_running(small_gold):
    res = [tuple(r) for r in ops.top_city_share(small_gold, k=2).collect()]
    assert res == [(1, 2, 0.4), (2, 2, 0.8)]


def test_peak_core_midnight(small_gold):
    peak = ops.peak_month(small_gold).first()
    assert (peak.txn_month_key, peak.revenue) == (201710, 100.0)
    # hours seen: 13, 0 (excluded), 12, NULL (excluded), 21 -> 2 of 3 in 11..20
    assert ops.core_hours_share(small_gold).first().core_share == round(2 / 3, 9)
    mid = ops.midnight_share(small_gold).first()
    assert (mid.n, mid.midnight_n) == (5, 1)


def test_quality_reports(spark, small_gold):
    audit = {r.is_named: r.n for r in ops.name_fallback_audit(small_gold).collect()}
    assert audit == {True: 4, False: 1}
    prof = ops.distinct_profile(small_gold).first()
    assert (prof.cities, prof.states, prof.categories) == (3, 1, 3)
    cats = [tuple(r) for r in ops.category_profile(small_gold).collect()]
    assert cats == [("A", 3, 140.0), ("B", 1, 50.0), ("Unknown category", 1, 20.0)]
    top = [tuple(r) for r in ops.city_volume_topn(small_gold, n=2).collect()]
    assert top == [(1, 2), (2, 2)]
    months = ops.month_profile(small_gold).collect()
    assert sum(r.n for r in months) == 5
    scale = ops.amount_scale_check(small_gold).first()
    assert (scale.n, scale.null_amounts, scale.out_of_scale) == (5, 0, 0)


def test_key_uniqueness_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "merchant_id string")
    r = ops.merchant_key_uniqueness(df).first()
    assert (r.row_count, r.distinct_ids) == (5, 3)


def test_layer_counts_and_fanout(spark, small_gold):
    counts = ops.layer_row_counts({"x": small_gold, "y": small_gold.limit(2)})
    assert sorted(map(tuple, counts.collect())) == [("x", 5), ("y", 2)]
    r = ops.join_fanout_check(small_gold, small_gold).first()
    assert r.silver_rows == r.gold_rows == 5
