"""Physical-plan properties that matter at scale, checked on a Gold parquet table."""

from __future__ import annotations

import re
import uuid

import pytest
from helpers import SF_SMALL

from ledgerlake import operators as ops
from ledgerlake.plans.registry import GOLD_OPS, gold
from ledgerlake.session import shared_dir


@pytest.fixture(scope="module")
def gold_table(spark):
    path = f"{shared_dir(spark)}/plans-{uuid.uuid4().hex[:10]}/gold"
    gold(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


def _read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("key", sorted(GOLD_OPS))
def test_no_cross_join_no_python_no_full_width_scan(gold_table, key):
    df = GOLD_OPS[key](gold_table)
    plan = _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{key}: {bad}"
    for schema in _read_schemas(df):
        assert schema.count(":") <= 6, f"{key} reads {schema}"


def test_top_n_limits_partially_before_the_shuffle(gold_table):
    plan = ops.q1_top_merchants_by_city_month(gold_table)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan
    # the partial group limit sits below (after, in the text) the window's exchange
    assert plan.rfind("Exchange hashpartitioning(txn_month_key", 0, partial) != -1


def test_slice_filters_reach_the_scan(spark, gold_table):
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # do not abbreviate the filter list
    try:
        df = ops.q1_slice(gold_table, ["Oct 1997"], [2, 3])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    pushed = re.findall(r"PushedFilters: (.*?), ReadSchema", plan)
    assert pushed and "In(city_id" in pushed[0]
    assert "EqualTo(txn_month_label" in pushed[0] and "EqualTo(txn_month_key,199710)" in pushed[0]


def test_aggregates_are_partial_then_final(gold_table):
    plan = ops.q2_avg_sale_by_merchant_state(gold_table)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "HashAggregate" in plan
    assert "SortAggregate" not in plan


def test_mix_broadcasts_only_the_bounded_top_list(gold_table):
    plan = ops.category_mix_top_cities(gold_table, top=6)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=6" in plan


@pytest.mark.parametrize("key", sorted(GOLD_OPS))
def test_every_operator_is_independent_of_partitioning(spark, gold_table, key):
    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = GOLD_OPS[key](gold_table.repartition(n))
        return sorted(repr(tuple(r)) for r in df.collect())

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert run(1) == run(7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("key", sorted(GOLD_OPS))
def test_every_operator_scans_gold_once(gold_table, key):
    """After AQE, each question reads Gold once; second uses reuse the shuffle."""
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
    from plan_summary import final_plan

    plan = final_plan(GOLD_OPS[key](gold_table))
    assert len(re.findall(r"FileScan parquet", plan)) == 1, plan
