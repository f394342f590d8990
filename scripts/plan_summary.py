"""Summarise the final (post-AQE) physical plan of every operator into PLANS.md.

Usage: python scripts/plan_summary.py [sf_dir] [out.md]

Builds the layers once, runs each Gold operator, and counts in its executed
plan: scans (and columns read), shuffles by kind, reused shuffles,
broadcasts, join and aggregate operators, partial group limits and top-k.
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerlake import operators as ops  # noqa: E402
from ledgerlake.plans.layers import read_gold, run_layers, stage_testdata_sources  # noqa: E402
from ledgerlake.plans.registry import GOLD_OPS  # noqa: E402
from ledgerlake.session import shared_dir  # noqa: E402
from ledgerlake.sources.tables import T_SILVER_MERCHANTS, T_SILVER_TRANSACTIONS, read_layer_table  # noqa: E402

PATTERNS = {
    "scans": r"(FileScan|Scan parquet)",
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "reused": r"Reused(Exchange|Subquery)",
    "broadcasts": r"BroadcastExchange",
    "BHJ": r"BroadcastHashJoin",
    "SMJ": r"SortMergeJoin",
    "HashAgg": r"HashAggregate",
    "SortAgg": r"SortAggregate",
    "partial group limit": r"WindowGroupLimit .*Partial",
    "top-k": r"TakeOrderedAndProject",
}


NOTES = """
## Reading the table

* Every question reads its few columns of Gold **once** (`scans` = 1). The cells of `cramers_v`
  and `category_mix_top_cities`, and the per-city counts of `top_city_share` (whose grand
  total sums them), are aggregated once; the second use reads the same shuffle (`reused`).
* Every aggregate is partial + final (`HashAgg` counts come in pairs). The two `SortAgg` pairs
  are the arg-max aggregates of `popular_merchants` and `dominant_category_by_city`, which sort
  already-aggregated rows.
* Rankings carry a partial `WindowGroupLimit` below their shuffle, so a hot key ships ≤ n rows
  per map task.
* Broadcasts are bounded: the top-k city list (≤ 6 rows), the row totals in `cramers_v` (one row
  per city, below Spark's size threshold at run time), and the merchant side of the Gold join
  (measured exactly, ≤ 256 MiB, else sort-merge).
* `range shuffles` are the final `orderBy` of a report's small result; `single-partition`
  shuffles carry one partial row per task into a global aggregate.
* The merchant de-duplication ships at most one row per merchant id per map task (partial group
  limit), then keeps one per id.
"""


# Plans printed in full after the table.
APPENDIX_KEYS = ["top_merchants_by_city_month", "cramers_v", "top_city_share", "gold join (layer job, sized broadcast)"]


def _drop_initial_plans(text: str) -> str:
    """Subquery plans print their final and initial plans; keep the final only."""
    out, skip_indent = [], None
    for line in text.splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_indent is not None:
            if indent >= skip_indent:
                continue
            skip_indent = None
        if "== Initial Plan ==" in line:
            skip_indent = indent
            continue
        out.append(line)
    return "\n".join(out)


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    try:
        plan = plan.finalPhysicalPlan()
    except Exception:  # not adaptive
        pass
    return _drop_initial_plans(plan.toString())


def columns_read(plan: str) -> str:
    widths = sorted({s.count(":") for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan)})
    return "/".join(str(w) for w in widths) or "0"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    paths = stage_testdata_sources(spark, sf_dir, f"{shared_dir(spark)}/plans-{uuid.uuid4().hex[:10]}")
    run_layers(spark, paths, ["all"])
    gold = read_gold(spark, paths.root)
    jobs = {key: (lambda op=op: op(gold)) for key, op in GOLD_OPS.items()}
    silver_t = read_layer_table(spark, T_SILVER_TRANSACTIONS, paths.root)
    silver_m = read_layer_table(spark, T_SILVER_MERCHANTS, paths.root)
    jobs["gold join (layer job, sized broadcast)"] = lambda: ops.build_gold(
        silver_t, silver_m, broadcast_max_bytes=paths.broadcast_max_bytes
    )
    jobs["merchant dedupe (silver)"] = lambda: ops.clean_merchants(
        spark.read.table("bronze.merchants")
    )
    header = ["key", "cols read"] + list(PATTERNS)
    lines = [
        "# Physical plans (final, after AQE)",
        "",
        f"Generated by `scripts/plan_summary.py` at `{sf_dir}` on local[8] with 8 shuffle partitions.",
        "Counts are operators in the executed plan (subqueries included). `cols read` is the number",
        "of columns in each distinct parquet ReadSchema (Gold has 24).",
        "",
        "| " + " | ".join(header) + " |",
        "| " + " | ".join("---" for _ in header) + " |",
    ]
    plans = {}
    for key, build in jobs.items():
        plan = final_plan(build())
        plans[key] = plan
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        lines.append("| " + " | ".join([f"`{key}`", columns_read(plan)] + counts) + " |")
    appendix = ["", "## Appendix: executed plans", ""]
    for key in APPENDIX_KEYS:
        text = "\n".join(line[:220] for line in plans[key].splitlines())
        appendix += [f"### `{key}`", "", "```", text, "```", ""]
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n" + NOTES + "\n".join(appendix))
    print(f"wrote {out}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
