"""Incremental Gold: a restarted stream takes only new files, once."""

from __future__ import annotations

import uuid

from helpers import SF_SMALL
from pyspark.sql import functions as F

from ledgerlake.operators import clean_merchants
from ledgerlake.plans.registry import gold, raw_merchants, raw_transactions
from ledgerlake.session import shared_dir
from ledgerlake.sources.schemas import GOLD_COLUMNS
from ledgerlake.streaming import IncrementalGold, start_incremental_gold


def _run(spark, cfg, merchants):
    q = start_incremental_gold(spark, cfg, merchants, available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_restart_processes_only_new_files_exactly_once(spark):
    base = f"{shared_dir(spark)}/stream-test-{uuid.uuid4().hex[:10]}"
    landing = f"{base}/landing"
    raw = raw_transactions(spark, SF_SMALL)
    first = raw.filter(F.col("month_lag") > -6)
    second = raw.filter(F.col("month_lag") <= -6)
    first.write.parquet(f"{landing}/batch=1")
    merchants = clean_merchants(raw_merchants(spark, SF_SMALL))
    cfg = IncrementalGold(
        transactions_dir=landing,
        gold_path=f"{base}/gold",
        checkpoint=f"{base}/ckpt",
        max_files_per_trigger=1,
    )
    _run(spark, cfg, merchants)
    n1 = spark.read.parquet(cfg.gold_path).count()
    assert n1 == first.count()

    # a second run with nothing new adds nothing
    _run(spark, cfg, merchants)
    assert spark.read.parquet(cfg.gold_path).count() == n1

    # new files land; the restarted query appends exactly those
    second.write.parquet(f"{landing}/batch=2")
    _run(spark, cfg, merchants)
    out = spark.read.parquet(cfg.gold_path).select(*GOLD_COLUMNS)
    batch = gold(spark, SF_SMALL)
    assert out.count() == batch.count() == 6000
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_stream_plan_is_stateless(spark):
    base = f"{shared_dir(spark)}/stream-plan-{uuid.uuid4().hex[:10]}"
    raw_transactions(spark, SF_SMALL).limit(10).write.parquet(f"{base}/in")
    from ledgerlake.streaming import incremental_gold_stream

    df = incremental_gold_stream(
        spark,
        IncrementalGold(f"{base}/in", f"{base}/out", f"{base}/ckpt"),
        clean_merchants(raw_merchants(spark, SF_SMALL)),
    )
    assert df.isStreaming
    plan = df._jdf.queryExecution().analyzed().toString()
    # no operator that keeps state across micro-batches
    for stateful in ("Aggregate", "Deduplicate", "FlatMapGroupsWithState", "EventTimeWatermark"):
        assert stateful not in plan
