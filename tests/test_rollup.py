"""Rollups and the evidence pass give what the operators over Gold give."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace

import pytest
from helpers import SF_SMALL, gold_of, merchant, txn
from pyspark.sql import functions as F

from ledgerlake import operators as ops
from ledgerlake.plans import layers
from ledgerlake.plans.registry import gold
from ledgerlake.session import shared_dir
from ledgerlake.sources import tables

REPORTS = {"city_scorecard": ops.city_scorecard, "category_scorecard": ops.category_scorecard, "monthly_seasonality": ops.monthly_seasonality,
           "hourly_curve": ops.hourly_curve, "installment_profit": ops.installment_profit, "month_profile": ops.month_profile,
           "category_profile": ops.category_profile, "city_volume_topn": ops.city_volume_topn}
QUESTIONS = [ops.q1_top_merchants_by_city_month, ops.q2_avg_sale_by_merchant_state, ops.q2_robust_top_per_state, ops.q3_top_hours_by_category,
             ops.q4_popular_merchants, lambda g: ops.q1_slice(g, ["Oct 1997"], [2, 3])]


def rows(df):
    return df.columns, list(map(repr, df.collect()))


@pytest.fixture(scope="module")
def built(spark):
    """All layers with their rollups, under a prefix of their own."""
    own = uuid.uuid4().hex[:8]
    landing = f"{shared_dir(spark)}/rollup-{own}"
    paths = replace(layers.stage_testdata_sources(spark, SF_SMALL, landing, f"r{own}_"), silver_buckets=4, broadcast_max_bytes=0)
    layers.run_layers(spark, paths)
    layers.run_rollups(spark, paths)
    yield paths
    tables.drop_namespaces(spark, landing, paths.catalog_prefix)


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_one_pass(spark, built, name):
    evidence = tables.read_layer_table(spark, tables.T_GOLD_EVIDENCE, built.root)
    assert rows(ops.evidence_report(evidence, name)) == rows(REPORTS[name](layers.read_gold(spark, built.root)))


def test_evidence_is_one_scan_and_one_shuffle(spark, built):
    plan = ops.merchant_evidence(layers.read_gold(spark, built.root))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan", plan)) == 1 and len(re.findall(r"Exchange", plan)) == 1
    with pytest.raises(ValueError, match="no such report"):
        ops.evidence_report(spark.range(1), "other")


@pytest.mark.parametrize("question", range(len(QUESTIONS)))
def test_questions_of_the_stored_rollup(spark, built, question):
    stored = tables.read_layer_table(spark, tables.T_GOLD_ROLLUP, built.root)
    assert rows(QUESTIONS[question](stored)) == rows(QUESTIONS[question](layers.read_gold(spark, built.root)))


def test_new_months_merge_in(spark, built):
    """Rolled up month by month, with every month's rows read once, the answers are those of all rows."""
    whole = layers.read_gold(spark, built.root)
    months = [r[0] for r in whole.select("txn_month_key").distinct().orderBy("txn_month_key").collect()]
    cut = months[len(months) // 2]
    late = F.col("txn_month_key") >= cut  # a NULL month stays with the early rows
    own = replace(built, root=f"{built.root}-months")
    tables.ensure_namespaces(spark, own.root, own.catalog_prefix)
    tables.overwrite_table(ops.sales_rollup(whole.where(~F.coalesce(late, F.lit(False)))), tables.T_GOLD_ROLLUP, own.root, prefix=own.catalog_prefix)
    layers.add_to_rollup(spark, own, whole.where(late & (F.col("city_id") < 9)))
    layers.add_to_rollup(spark, own, whole.where(late & ~F.coalesce(F.col("city_id") < 9, F.lit(False))))
    merged = tables.read_layer_table(spark, tables.T_GOLD_ROLLUP, own.root)
    assert merged.count() == merged.select(*ops.rollup.ROLLUP_KEYS).distinct().count()
    for question in QUESTIONS:
        assert rows(question(merged)) == rows(question(whole))


def test_odd_amounts_and_nulls(spark):
    made = [txn("M_1", a, city=c, category=k, date=d) for a in (0.1, None, 1e12, float("nan"), float("inf"), -0.25, 1 / 3)
            for c in (None, 3) for k in (None, "A") for d in ("2017-10-01 13:00:00", "bad")]
    g = gold_of(spark, made + [txn(None, 1.5)], [merchant("M_1")])
    half = F.pmod(F.xxhash64(*g.columns), F.lit(2)) == 0
    merged = ops.merge_rollups(ops.sales_rollup(g.where(half)), ops.sales_rollup(g.where(~half)))
    for question in QUESTIONS[1:5]:
        assert rows(question(merged)) == rows(question(g))
    assert ops.sales_rollup(g.limit(0)).count() == 0


def test_distinct_states(spark, built):
    whole = layers.read_gold(spark, built.root)
    states = ops.distinct_states(whole)
    assert rows(ops.distinct_profile_of(states)) == rows(ops.distinct_profile(whole))
    assert "Expand" not in ops.distinct_profile_of(states)._jdf.queryExecution().executedPlan().toString()
    parts = [ops.distinct_states(whole.where(F.pmod(F.xxhash64("purchase_ts"), F.lit(3)) == k)) for k in range(3)]
    wide = whole.limit(50).withColumn("city_id", (F.monotonically_increasing_id() * 40_000 - 900_000).cast("int"))
    merged = ops.merge_distinct_states(*parts, parts[0], ops.distinct_states(wide))
    assert rows(ops.distinct_profile_of(merged)) == rows(ops.distinct_profile(whole.unionByName(wide)))
    none = whole.limit(0)
    assert rows(ops.distinct_profile_of(ops.distinct_states(none))) == rows(ops.distinct_profile(none))


def test_bucketed_gold_is_the_same_gold(spark, built):
    written, lazy = layers.read_gold(spark, built.root), gold(spark, SF_SMALL)
    assert written.count() == 6000 and written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0


@pytest.mark.parametrize("share", [0.0, 0.05, 1.0])
def test_bucketed_join_shuffles_no_facts(spark, built, share):
    facts, side = (tables.read_bucketed_table(spark, t, built.root) for t in (tables.T_SILVER_TRANSACTIONS, tables.T_SILVER_MERCHANTS))
    hot = ops.hot_merchants(facts, facts.count(), share)
    assert (share < 1 or not hot) and len(hot) <= (1 / share if share else 10**9)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = ops.build_gold_bucketed(facts, side, hot)
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("BroadcastExchange", "") and "SortMergeJoin" in plan
        lazy = gold(spark, SF_SMALL)
        assert both.exceptAll(lazy).count() == 0 and both.count() == 6000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counts_of_the_writes(spark, built):
    g = layers.read_gold(spark, built.root)
    found = tables.run_metrics(spark, tables.T_GOLD_TRANSACTIONS, built.root)
    audit = {r.is_named: r.n for r in ops.name_fallback_audit(g).collect()}
    assert found == {"rows": g.count(), "named": audit.get(True, 0), "unnamed": audit.get(False, 0)}
