"""Benchmark: build the layers once, then run every Gold operator on the table.

Mirrors how the engine is used: Bronze → Silver → Gold are persisted tables,
and questions read the Gold table.  Prints one JSON line:

  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``queries`` holds per-key seconds (best of ``BENCH_REPEATS`` runs, default 5,
each written to Spark's ``noop`` sink), plus ``stage_sources`` (landing the adapter-derived
raw files) and ``layers_build`` (Bronze+Silver+Gold writes).  ``value`` = the
sum of all of them.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEATS (default 5), BENCH_EVENT_LOG_DIR (optional: write
Spark's event log there, for stage and task times).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerlake import operators as ops  # noqa: E402
from ledgerlake.plans.layers import read_gold, run_layers, stage_testdata_sources  # noqa: E402
from ledgerlake.plans.registry import GOLD_OPS  # noqa: E402
from ledgerlake.session import RECOMMENDED_CONF, shared_dir  # noqa: E402
from ledgerlake.sources.tables import (  # noqa: E402
    T_BRONZE_MERCHANTS,
    T_BRONZE_TRANSACTIONS,
    T_SILVER_MERCHANTS,
    T_SILVER_TRANSACTIONS,
    read_layer_table,
)


def _sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    timings: dict[str, float] = {}
    landing = f"{shared_dir(spark)}/bench-{uuid.uuid4().hex[:12]}"

    t0 = time.perf_counter()
    paths = stage_testdata_sources(spark, sf_dir, landing)
    timings["stage_sources"] = time.perf_counter() - t0

    t0 = time.perf_counter()
    run_layers(spark, paths, ["all"])
    timings["layers_build"] = time.perf_counter() - t0

    gold = read_gold(spark, paths.root)
    silver_m = read_layer_table(spark, T_SILVER_MERCHANTS, paths.root)
    silver_t = read_layer_table(spark, T_SILVER_TRANSACTIONS, paths.root)
    cross_layer = {
        "layer_row_counts": lambda: ops.layer_row_counts(
            {
                "bronze.merchants": read_layer_table(spark, T_BRONZE_MERCHANTS, paths.root),
                "silver.merchants": silver_m,
                "bronze.transactions": read_layer_table(spark, T_BRONZE_TRANSACTIONS, paths.root),
                "silver.transactions": silver_t,
                "gold.transactions_enriched": gold,
            }
        ),
        "merchant_key_uniqueness": lambda: ops.merchant_key_uniqueness(silver_m),
        "join_fanout_check": lambda: ops.join_fanout_check(silver_t, gold),
    }
    jobs = {key: (lambda op=op: op(gold)) for key, op in GOLD_OPS.items()}
    jobs.update(cross_layer)

    errors: dict[str, str] = {}
    for key, build in jobs.items():
        best = float("inf")
        try:
            for _ in range(repeats):
                t0 = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                best = min(best, time.perf_counter() - t0)
        except Exception as exc:  # keep timing the others; report the failure
            errors[key] = f"{type(exc).__name__}: {str(exc)[:200]}"
            continue
        timings[key] = best

    total = sum(timings.values())
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timings.items()},
                "sf": _sf_of(sf_dir),
                "cpus": cpus,
                "spark": spark.version,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
