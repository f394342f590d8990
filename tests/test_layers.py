"""Layer jobs, the CSV source and table round trips."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
import uuid

import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from ledgerlake.plans.layers import (
    LayerPaths,
    bronze_table,
    gold_incremental,
    layer_round_trip,
    read_gold,
    resolve_layers,
    run_layers,
    stage_testdata_sources,
)
from ledgerlake.session import shared_dir
from ledgerlake.sources import read_merchants_csv
from ledgerlake.sources.schemas import GOLD_COLUMNS, MERCHANT_CSV_COLUMNS
from ledgerlake.sources.tables import (
    T_BRONZE_MERCHANTS,
    T_SILVER_MERCHANTS,
    ensure_namespaces,
    overwrite_table,
    read_layer_table,
)
from ledgerlake.plans.registry import gold, raw_merchants


@pytest.mark.parametrize("requested, expected", [
    (["all"], "bronze silver gold"),
    (["gold", "silver"], "silver gold"),
    (["bronze"] * 3, "bronze"),
    (["all", "iron"], "bronze silver gold"),
    ([], ""),
])
def test_resolve_layers(requested, expected):
    assert resolve_layers(requested) == expected.split()


def test_unknown_layers_are_named():
    with pytest.raises(ValueError, match="iron, tin"):
        resolve_layers(["tin", "gold", "iron"])


def _fresh(spark) -> str:
    return f"{shared_dir(spark)}/t-{uuid.uuid4().hex[:10]}"


def test_csv_binds_by_position_and_reads_empties_as_null(spark):
    path = _fresh(spark) + "/m.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    header = ",".join(f"h{i}" for i in range(20))  # header names are not enforced
    full = ",".join(["Name A", "M_1", "3"] + [""] * 15 + ["7", "9"])
    short = 'Name B,M_2,""'
    long = ",".join(["Name C", "M_3", "4"] + ["x"] * 15 + ["8", "1", "extra", "more"])
    with open(path, "w") as fh:
        fh.write("\n".join([header, full, short, long]) + "\n")
    df = read_merchants_csv(spark, path)
    assert df.columns == MERCHANT_CSV_COLUMNS
    rows = {r.merchant_id: r for r in df.collect()}
    assert (rows["M_1"].merchant_name, rows["M_1"].city_id, rows["M_1"].state_id) == ("Name A", "7", "9")
    assert rows["M_1"].numerical_1 is None
    assert rows["M_2"].merchant_group_id is None and rows["M_2"].state_id is None
    assert (rows["M_3"].city_id, rows["M_3"].state_id) == ("8", "1")  # long row truncated


def test_run_layers_round_trip_matches_lazy_pipeline(spark):
    landing = _fresh(spark)
    paths = stage_testdata_sources(spark, SF_SMALL, landing)
    assert isinstance(paths, LayerPaths)
    assert run_layers(spark, paths, ["all"]) == ["bronze", "silver", "gold"]
    assert read_layer_table(spark, T_BRONZE_MERCHANTS, paths.root).count() == raw_merchants(spark, SF_SMALL).count()
    assert read_layer_table(spark, T_SILVER_MERCHANTS, paths.root).count() == 9
    written = read_gold(spark, paths.root)
    assert written.columns == GOLD_COLUMNS
    lazy = gold(spark, SF_SMALL)
    assert written.count() == lazy.count() == 6000
    assert written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0


def test_rerunning_one_layer_is_idempotent(spark):
    landing = _fresh(spark)
    paths = stage_testdata_sources(spark, SF_SMALL, landing)
    run_layers(spark, paths, ["all"])
    before = read_gold(spark, paths.root).count()
    run_layers(spark, paths, ["gold"])
    assert read_gold(spark, paths.root).count() == before


def test_registered_round_trip(spark):
    assert layer_round_trip(spark, SF_SMALL).count() == 6000


def test_results_that_outlive_their_layers_are_the_written_files(spark):
    """Taken over, not copied: a checkpoint would write every row once more, and has no input files."""
    found = layer_round_trip(spark, SF_SMALL)
    assert found.inputFiles() and all("/kept-" in f for f in found.inputFiles())
    assert found.columns == list(GOLD_COLUMNS)
    lazy = gold(spark, SF_SMALL)
    assert found.exceptAll(lazy).count() == 0 and lazy.exceptAll(found).count() == 0
    assert bronze_table(spark, SF_SMALL, T_BRONZE_MERCHANTS).inputFiles()
    assert gold_incremental(spark, SF_SMALL).inputFiles()


def test_cli_runs_chosen_layers(spark):
    from ledgerlake.plans.cli import main, parse_args

    args = parse_args(["--merchants-csv", "m", "--transactions", "t", "--root", "r/"])
    assert args.layers == ["all"] and args.gold_partition_by == []
    landing = _fresh(spark)
    paths = stage_testdata_sources(spark, SF_SMALL, landing)
    done = main([
        "--layers", "silver", "bronze",
        "--merchants-csv", paths.merchants_csv,
        "--transactions", paths.transactions_parquet,
        "--root", paths.root,
    ])
    assert done == ["bronze", "silver"]
    assert read_layer_table(spark, T_SILVER_MERCHANTS, paths.root).count() == 9


def test_bronze_can_register_instead_of_copy(spark):
    from dataclasses import replace

    from ledgerlake.sources.tables import T_BRONZE_TRANSACTIONS

    landing = _fresh(spark)
    paths = replace(stage_testdata_sources(spark, SF_SMALL, landing), bronze_copy_transactions=False)
    run_layers(spark, paths, ["all"])
    bronze_files = spark.read.table(T_BRONZE_TRANSACTIONS).inputFiles()
    assert bronze_files and all(paths.transactions_parquet in f for f in bronze_files)
    written = read_gold(spark, paths.root)
    lazy = gold(spark, SF_SMALL)
    assert written.count() == 6000
    assert written.exceptAll(lazy).count() == 0 and lazy.exceptAll(written).count() == 0


def test_registered_keys_leave_nothing_behind(spark):
    def namespaces():
        return {r[0] for r in spark.sql("SHOW NAMESPACES").collect()}

    def folders():
        return {f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith(("layers-", "stream-"))}

    before = namespaces(), folders()
    first, second = layer_round_trip(spark, SF_SMALL), layer_round_trip(spark, SF_SMALL)
    assert first.count() == second.count() == 6000
    assert gold_incremental(spark, SF_SMALL).count() == 6000
    assert (namespaces(), folders()) == before


def test_a_failed_write_keeps_the_rows_and_a_rerun_succeeds(spark):
    root = _fresh(spark)
    ensure_namespaces(spark, root, "f_")
    overwrite_table(spark.range(5).toDF("v"), "gold.kept", root, prefix="f_")
    fails = spark.range(100).repartition(4).select(F.when(F.col("id") < 99, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("long")).alias("v"))
    with pytest.raises(Exception, match="half-way"):
        overwrite_table(fails, "gold.kept", root, prefix="f_")
    assert read_layer_table(spark, "gold.kept", root).count() == 5
    assert spark.read.table("f_gold.kept").count() == 5
    overwrite_table(spark.range(7).toDF("v"), "gold.kept", root, prefix="f_", keep_seconds=0)
    assert read_layer_table(spark, "gold.kept", root).count() == spark.read.table("f_gold.kept").count() == 7
    runs = os.listdir(f"{root}/gold/kept".removeprefix("file:"))
    assert len([r for r in runs if r.startswith("run-")]) == 1
    with pytest.raises(FileNotFoundError):
        read_layer_table(spark, "gold.never_written", root)


def test_layers_run_as_processes_of_their_own(spark):
    """Three processes share nothing but ``root``."""
    paths = stage_testdata_sources(spark, SF_SMALL, _fresh(spark))
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"PYTHONPATH": repo, "PYSPARK_SUBMIT_ARGS": "--conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=2 --master local[2] pyspark-shell"}
    with tempfile.TemporaryDirectory() as cwd:
        for layer in ("bronze", "silver", "gold"):
            args = ["--layers", layer, "--merchants-csv", paths.merchants_csv, "--transactions", paths.transactions_parquet, "--root", paths.root]
            subprocess.run([sys.executable, "-m", "ledgerlake.plans.cli", *args], cwd=cwd, env=env, check=True, timeout=300, capture_output=True)
    written, lazy = read_gold(spark, paths.root), gold(spark, SF_SMALL)
    assert written.count() == 6000 and written.exceptAll(lazy).count() == 0


def test_a_slice_of_clustered_gold_reads_less(spark):
    from dataclasses import replace

    from ledgerlake.operators import q1_slice

    paths = stage_testdata_sources(spark, SF_SMALL, _fresh(spark))
    rows = {}
    layouts = {"as written": {"gold_page_rows": 10_000}, "pages": {"gold_page_rows": 50}, "files": {"gold_cluster_files": 12}}
    for files, layout in layouts.items():
        own = replace(paths, root=f"{paths.root}-{files.replace(' ', '')}", catalog_prefix=f"c{len(files)}_", **layout)
        run_layers(spark, own, ["all"])
        scanned = read_gold(spark, own.root)
        part = q1_slice(scanned, ["Oct 1997", "Nov 1997"], [2, 3])
        result = sorted(map(tuple, part.collect()))
        plan = part._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves() if not plan.getClass().getSimpleName().startswith("Adaptive") else plan.executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.length())]
        while any(x.getClass().getSimpleName().endswith("QueryStageExec") for x in scans):
            scans = [y.apply(i) for x in scans for y in [x.plan().collectLeaves() if x.getClass().getSimpleName().endswith("QueryStageExec") else None] if y is not None for i in range(y.length())]
        rows[files] = sum(x.metrics().apply("numOutputRows").value() for x in scans if x.metrics().contains("numOutputRows")), result
    whole, answer = rows["as written"]
    assert rows["files"][1] == rows["pages"][1] == answer
    assert rows["files"][0] < whole / 2
    assert rows["pages"][0] < whole / 4  # no shuffle: each file's pages of other months and cities are skipped


def test_a_repeated_call_resumes(spark, monkeypatch):
    """Killed between layers, then called again: nothing is written twice, and a changed source is followed through."""
    from ledgerlake.plans import layers
    from ledgerlake.sources import tables

    paths = stage_testdata_sources(spark, SF_SMALL, _fresh(spark), "res_")
    names = (T_BRONZE_MERCHANTS, tables.T_BRONZE_TRANSACTIONS, T_SILVER_MERCHANTS, tables.T_SILVER_TRANSACTIONS, tables.T_GOLD_TRANSACTIONS)

    def runs():
        return {name: tables.table_runs(spark, name, paths.root) for name in names}

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setitem(layers._RUNNERS, "gold", killed)
    with pytest.raises(KeyboardInterrupt):
        run_layers(spark, paths, resume=True)
    monkeypatch.undo()
    half = runs()
    assert [len(r) for r in half.values()] == [1, 1, 1, 1, 0]
    for _ in range(2):
        run_layers(spark, paths, resume=True)
        assert runs() | {names[4]: []} == half and len(runs()[names[4]]) == 1
    sources_of = raw_merchants(spark, SF_SMALL).limit(5)
    from ledgerlake.sources.files import write_merchants_csv
    from ledgerlake.sources.testdata import raw_merchants_csv_layout

    write_merchants_csv(raw_merchants_csv_layout(sources_of), paths.merchants_csv)
    run_layers(spark, paths, resume=True)
    assert [len(r) for r in runs().values()] == [2, 1, 2, 1, 2]
    assert read_gold(spark, paths.root).count() == 6000
    run_layers(spark, paths, ["silver"])
    assert [len(r) for r in runs().values()] == [2, 1, 3, 2, 2]


def test_only_months_of_changed_merchants_are_rewritten(spark):
    from helpers import merchant, merchants, txn, txns

    from ledgerlake.plans.layers import refresh_gold_months, run_gold, run_silver
    from ledgerlake.sources import tables

    landing = _fresh(spark)
    paths = LayerPaths(f"{landing}/csv", f"{landing}/sales", f"{landing}/root", gold_partition_by=("txn_month_key",), catalog_prefix="mon_", keep_seconds=0)
    sales = [txn(f"M_{k % 7}", 1.5 * k, date=f"2017-{1 + k % 10:02d}-01 13:00:00") for k in range(70) if k % 7 != 3 or k % 10 == 4]
    txns(spark, [*sales, txn("M_3", 9.0, date="bad"), txn("M_9", 1.0, date="2017-03-01 01:00:00"), txn(None, 2.0)]).write.parquet(paths.transactions_parquet)

    def land(rows):
        from ledgerlake.sources.schemas import MERCHANT_CSV_COLUMNS

        raw = merchants(spark, rows)
        wide = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in MERCHANT_CSV_COLUMNS])
        wide.write.mode("overwrite").option("header", True).csv(paths.merchants_csv)
        run_layers(spark, paths, ["bronze", "silver"], resume=True)

    def parts():
        return tables.table_parts(spark, tables.T_GOLD_TRANSACTIONS, paths.root)

    land([merchant(f"M_{k}") for k in range(7)])
    run_gold(spark, paths)
    first = parts()
    assert refresh_gold_months(spark, paths) == [] and parts() == first
    # M_3 (one month, and rows without one) is renamed, M_9 is new: its only month changes.
    paths_kept = paths.__class__(**{**paths.__dict__, "keep_seconds": 3600.0})
    paths = paths_kept
    land([merchant(f"M_{k}", "Renamed" if k == 3 else None) for k in range(7)] + [merchant("M_9")])
    months = refresh_gold_months(spark, paths)
    assert months == [None, 201703, 201705]
    second = parts()
    assert sum(second[p] != first[p] for p in first) == 3 and set(second) == set(first)
    written = read_gold(spark, paths.root)
    assert written.where("merchant_name = 'Renamed'").count() == 2
    by_name = spark.read.table("mon_gold.transactions_enriched").select(*GOLD_COLUMNS)
    metrics = tables.run_metrics(spark, tables.T_GOLD_TRANSACTIONS, paths.root)
    run_gold(spark, paths)
    whole = read_gold(spark, paths.root)
    assert metrics["rows"] == whole.count() == written.count()
    assert written.exceptAll(whole).count() == whole.exceptAll(written).count() == 0
    assert by_name.columns == GOLD_COLUMNS
    # A change of the sales is a refresh of all.
    run_silver(spark, paths)
    assert refresh_gold_months(spark, paths) == [] and read_gold(spark, paths.root).count() == metrics["rows"]


def test_partitions_kept_by_a_version_outlive_their_run(spark):
    from ledgerlake.sources import tables

    root = _fresh(spark)
    ensure_namespaces(spark, root, "p_")
    rows = spark.range(20).selectExpr("id", "if(id < 2, null, id % 3) AS k")
    overwrite_table(rows, "gold.parts", root, ["k"], prefix="p_")
    for turn in range(2):
        changed = rows.where("k = 1").selectExpr(f"id + {100 * (turn + 1)} AS id", "k")
        tables.overwrite_partitions(changed, "gold.parts", root, "k", [1], prefix="p_", keep_seconds=0)
        want = sorted(((r.id + (100 * (turn + 1) if r.k == 1 else 0), r.k) for r in rows.collect()))
        assert sorted(tuple(r) for r in read_layer_table(spark, "gold.parts", root).select("id", "k").collect()) == want
        assert sorted(tuple(r) for r in spark.read.table("p_gold.parts").select("id", "k").collect()) == want
    assert len(tables.table_runs(spark, "gold.parts", root)) == 1
    with pytest.raises(ValueError, match="other partitions"):
        tables.overwrite_partitions(rows, "gold.parts", root, "k", [1], prefix="p_")
    assert len([f for f in os.listdir(f"{root}/gold/parts".removeprefix("file:")) if f.startswith("run-")]) <= 3
