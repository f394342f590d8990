"""Layer jobs: Bronze lands, Silver cleans, Gold joins.

Layers talk only through persisted tables under ``root`` — a folder all
executors can reach (``ledgerlake.session.shared_dir`` by default) — so any
single layer can be re-run, also by a process of its own that knows nothing but
``root``.  Each write is a full refresh that replaces the table only once it is
complete.  Writing a layer table also cuts the lineage: a lost executor
re-reads the previous layer rather than recomputing the whole chain.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import build_gold, build_gold_bucketed, changed_merchants, clean_merchants, clean_transactions, hot_merchants
from ..operators.joins import broadcast_if_small, measured_bytes
from ..operators.rollup import merchant_evidence, merge_rollups, sales_rollup
from ..session import shared_dir
from ..sources.files import (
    read_merchants_csv,
    read_transactions_parquet,
    write_merchants_csv,
    write_parquet,
)
from ..sources.tables import (
    KEEP_SECONDS,
    T_BRONZE_MERCHANTS,
    T_BRONZE_TRANSACTIONS,
    T_GOLD_EVIDENCE,
    T_GOLD_ROLLUP,
    T_GOLD_TRANSACTIONS,
    T_SILVER_MERCHANTS,
    T_SILVER_TRANSACTIONS,
    drop_namespaces,
    ensure_namespaces,
    move_files,
    overwrite_partitions,
    overwrite_table,
    read_bucketed_table,
    read_layer_table,
    register_external_parquet,
    run_inputs,
    run_metrics,
    source_state,
    table_location,
    table_runs,
)
from ..sources.schemas import GOLD_COLUMNS
from ..sources.testdata import raw_merchants, raw_merchants_csv_layout, raw_transactions

# Fixed value: canonical layer order.
LAYERS = ("bronze", "silver", "gold")


# Largest merchant side (exact in-memory bytes) the Gold job broadcasts.
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024


# Distinct merchant ids that a Bloom filter of one row group of Gold is sized for.
BLOOM_MERCHANTS = 100_000


@dataclass(frozen=True)
class LayerPaths:
    """Where the raw sources are landed and where layer tables are written.

    ``gold_partition_by`` (e.g. ``("txn_month_key",)``) lays Gold out in one
    folder per value so month-restricted questions skip other months.  It is
    off by default: every write task writes one file per value it holds, so
    unless the transactions arrive clustered by time the table fragments into
    tasks × months small files.  ``broadcast_max_bytes`` bounds the merchant
    side the Gold join may broadcast (0 leaves the choice to Spark);
    ``salt_buckets`` salts the join when it is not broadcast (for clusters
    without AQE skew handling).  ``bronze_copy_transactions=False`` registers
    the landed transaction parquet as the Bronze table instead of copying it —
    no full read and write of the fact data per refresh, at the price of
    Bronze following later changes to the landing folder.
    """

    merchants_csv: str
    transactions_parquet: str
    root: str
    gold_partition_by: tuple[str, ...] = ()
    broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES
    salt_buckets: int = 0
    bronze_copy_transactions: bool = True
    # Files to cluster Gold into by ranges of (month, city); 0 leaves rows in the files the join gives.
    gold_cluster_files: int = 0
    # Buckets of merchant_id that both Silver tables are written in; 0 for none.  With buckets, a merchant
    # side beyond ``broadcast_max_bytes`` is joined without a shuffle.
    silver_buckets: int = 0
    # Rows to a parquet page of Gold.  Files are sorted by month and city, so the pages' own minima and maxima
    # let a slice skip the others; merchant ids get Bloom filters.
    gold_page_rows: int = 20_000
    # How long a replaced run of a table stays readable.
    keep_seconds: float = KEEP_SECONDS
    # Catalog namespaces become {prefix}bronze, {prefix}silver, {prefix}gold,
    # so several pipelines (or test runs) can share one session.
    catalog_prefix: str = ""


def resolve_layers(requested: Iterable[str]) -> list[str]:
    """The layers named, each once, in the order they build on each other; ``all`` is every layer.

    ``all`` anywhere wins (other names are then not checked); an unknown name
    raises ``ValueError``.
    """
    names = set(requested)
    if "all" in names:
        names = set(LAYERS)
    if wrong := names.difference(LAYERS):
        raise ValueError(f"no such layer: {', '.join(sorted(wrong))} (there are {', '.join(LAYERS)} and all)")
    return sorted(names, key=LAYERS.index)


def _run_together(*jobs: Callable[[], None]) -> None:
    """Run independent table writes as concurrent Spark jobs.

    The merchant and transaction tables of a layer do not depend on each
    other; submitting both at once lets the small merchant job run in the
    cluster's spare slots instead of after the big one.  The first failure is
    raised.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for future in [pool.submit(job) for job in jobs]:
            future.result()


def _made_from(spark: SparkSession, root: str, *names: str, **settings) -> dict:
    """The present runs of a job's input tables, and the settings its result depends on."""
    return {name: table_runs(spark, name, root)[-1] for name in names} | settings


def _refresh(spark: SparkSession, paths: LayerPaths, table: str, inputs: dict, resume: bool, write: Callable[[dict], None]) -> None:
    """Run ``write`` with what every table write of these paths shares, unless resuming and the table is already made from ``inputs``."""
    if resume and run_inputs(spark, table, paths.root) == inputs:
        return
    write({"root": paths.root, "prefix": paths.catalog_prefix, "keep_seconds": paths.keep_seconds, "inputs": inputs})


def run_bronze(spark: SparkSession, paths: LayerPaths, resume: bool = False) -> None:
    """Land both raw sources verbatim as Bronze tables."""
    ensure_namespaces(spark, paths.root, paths.catalog_prefix)

    def merchants(shared: dict) -> None:
        overwrite_table(read_merchants_csv(spark, paths.merchants_csv), T_BRONZE_MERCHANTS, **shared)

    def transactions(shared: dict) -> None:
        if paths.bronze_copy_transactions:
            overwrite_table(read_transactions_parquet(spark, paths.transactions_parquet), T_BRONZE_TRANSACTIONS, **shared)
        else:
            register_external_parquet(spark, T_BRONZE_TRANSACTIONS, paths.transactions_parquet, **shared)

    def land(table: str, source: str, write: Callable[[dict], None], **settings) -> None:
        _refresh(spark, paths, table, {"files": source_state(spark, source), **settings}, resume, write)

    _run_together(lambda: land(T_BRONZE_MERCHANTS, paths.merchants_csv, merchants),
                  lambda: land(T_BRONZE_TRANSACTIONS, paths.transactions_parquet, transactions, copy=paths.bronze_copy_transactions))


def run_silver(spark: SparkSession, paths: LayerPaths, resume: bool = False) -> None:
    """Clean Bronze into the two Silver tables."""
    ensure_namespaces(spark, paths.root, paths.catalog_prefix)
    buckets = ("merchant_id", paths.silver_buckets) if paths.silver_buckets else None

    def clean(source: str, table: str, operator: Callable[[DataFrame], DataFrame]) -> None:
        inputs = _made_from(spark, paths.root, source, buckets=paths.silver_buckets)

        def write(shared: dict) -> None:
            cleaned = operator(read_layer_table(spark, source, paths.root, run=inputs[source]))
            overwrite_table(cleaned, table, bucket_by=buckets, **shared)

        _refresh(spark, paths, table, inputs, resume, write)

    _run_together(lambda: clean(T_BRONZE_MERCHANTS, T_SILVER_MERCHANTS, clean_merchants),
                  lambda: clean(T_BRONZE_TRANSACTIONS, T_SILVER_TRANSACTIONS, clean_transactions))


def _skipping(paths: LayerPaths) -> dict[str, str]:
    """Writer options that let readers skip pages and row groups of Gold."""
    return {"parquet.page.row.count.limit": str(paths.gold_page_rows), "parquet.bloom.filter.enabled#merchant_id": "true",
            "parquet.bloom.filter.expected.ndv#merchant_id": str(BLOOM_MERCHANTS)}


def _gold_inputs(spark: SparkSession, paths: LayerPaths) -> dict:
    return _made_from(spark, paths.root, T_SILVER_MERCHANTS, T_SILVER_TRANSACTIONS, partitions=list(paths.gold_partition_by),
                      files=paths.gold_cluster_files, page_rows=paths.gold_page_rows)


def run_gold(spark: SparkSession, paths: LayerPaths, resume: bool = False) -> None:
    """Join Silver into the Gold enriched-transactions table."""
    ensure_namespaces(spark, paths.root, paths.catalog_prefix)
    inputs = _gold_inputs(spark, paths)

    def write(shared: dict) -> None:
        merchants = read_layer_table(spark, T_SILVER_MERCHANTS, paths.root, run=inputs[T_SILVER_MERCHANTS])
        if paths.silver_buckets and measured_bytes(merchants) > paths.broadcast_max_bytes:
            gold = _bucketed_gold(spark, paths, inputs)
        else:
            gold = build_gold(
                read_layer_table(spark, T_SILVER_TRANSACTIONS, paths.root, run=inputs[T_SILVER_TRANSACTIONS]),
                merchants,
                broadcast_max_bytes=paths.broadcast_max_bytes,
                salt_buckets=paths.salt_buckets,
            )
        gold = cluster_gold(gold, paths.gold_cluster_files)
        named = F.col("merchant_name") != F.col("merchant_id")
        counts = {"named": F.count_if(named), "unnamed": F.count_if(~named)}  # the rest: without name or id
        overwrite_table(gold, T_GOLD_TRANSACTIONS, partition_by=paths.gold_partition_by, counts=counts, options=_skipping(paths), **shared)

    _refresh(spark, paths, T_GOLD_TRANSACTIONS, inputs, resume, write)


def _bucketed_gold(spark: SparkSession, paths: LayerPaths, runs: dict) -> DataFrame:
    transactions, merchants = (read_bucketed_table(spark, t, paths.root, runs[t]) for t in (T_SILVER_TRANSACTIONS, T_SILVER_MERCHANTS))
    rows = run_metrics(spark, T_SILVER_TRANSACTIONS, paths.root, runs[T_SILVER_TRANSACTIONS])["rows"]
    return build_gold_bucketed(transactions, merchants, hot_merchants(transactions, rows, 1 / paths.silver_buckets))


_MONTH = "txn_month_key"


def refresh_gold_months(spark: SparkSession, paths: LayerPaths) -> list:
    """Bring Gold up to date after a merchant refresh: only months with sales of changed merchants are rewritten.

    Needs Gold partitioned by month.  Changed merchants are found by comparing
    the Silver run that Gold was made from with the present one; their months
    by a semi-join (the ids are broadcast if they measure small enough).
    Returns the months rewritten.  Where anything but the merchants has
    changed, or the earlier run is gone, Gold is refreshed whole (returns [] after it).
    """
    before, now = run_inputs(spark, T_GOLD_TRANSACTIONS, paths.root), _gold_inputs(spark, paths)
    alone = {k: v for k, v in before.items() if k != T_SILVER_MERCHANTS} == {k: v for k, v in now.items() if k != T_SILVER_MERCHANTS}
    if paths.gold_partition_by != (_MONTH,) or not alone or before[T_SILVER_MERCHANTS] not in table_runs(spark, T_SILVER_MERCHANTS, paths.root):
        run_gold(spark, paths, resume=True)
        return []
    old, new = (read_layer_table(spark, T_SILVER_MERCHANTS, paths.root, run=r[T_SILVER_MERCHANTS]) for r in (before, now))
    transactions = read_layer_table(spark, T_SILVER_TRANSACTIONS, paths.root, run=now[T_SILVER_TRANSACTIONS])
    changed, _ = broadcast_if_small(changed_merchants(old, new), paths.broadcast_max_bytes)
    touched = transactions.join(changed, "merchant_id", "left_semi").select(_MONTH).distinct()
    months = sorted((r[0] for r in touched.collect()), key=lambda m: (m is not None, m or 0))
    if months:
        known = [m for m in months if m is not None]
        wanted = F.col(_MONTH).isin(known) if known else F.lit(False)
        if None in months:
            wanted = wanted | F.col(_MONTH).isNull()
        gold = cluster_gold(build_gold(transactions.where(wanted), new, paths.broadcast_max_bytes, paths.salt_buckets), paths.gold_cluster_files)
        overwrite_partitions(gold, T_GOLD_TRANSACTIONS, paths.root, _MONTH, months, paths.catalog_prefix, paths.keep_seconds, now, _skipping(paths))
    return months


def run_rollups(spark: SparkSession, paths: LayerPaths) -> None:
    """Write Gold's sales rollup and the evidence for a new merchant, as tables beside Gold."""
    gold, pre = read_gold(spark, paths.root), paths.catalog_prefix
    overwrite_table(sales_rollup(gold), T_GOLD_ROLLUP, paths.root, prefix=pre, keep_seconds=paths.keep_seconds)
    overwrite_table(merchant_evidence(gold), T_GOLD_EVIDENCE, paths.root, prefix=pre, keep_seconds=paths.keep_seconds)


def add_to_rollup(spark: SparkSession, paths: LayerPaths, new_gold: DataFrame) -> None:
    """Merge rows that were not in the stored rollup (such as a new month's) into it; older Gold rows are not read."""
    rolled = merge_rollups(read_layer_table(spark, T_GOLD_ROLLUP, paths.root), sales_rollup(new_gold))
    overwrite_table(rolled, T_GOLD_ROLLUP, paths.root, prefix=paths.catalog_prefix, keep_seconds=paths.keep_seconds)


def cluster_gold(gold: DataFrame, files: int = 0) -> DataFrame:
    """Gold sorted by (month key, city) within each file; with ``files``, dealt out to that many ranges of them first.

    Sorting alone costs no shuffle: a slice then reads a few pages of each
    file.  Ranges put a slice into few files, for one shuffle of Gold; a month
    or city with very many rows is spread over several by the merchant id and
    the time of purchase, so no task gathers it.
    """
    place = ["txn_month_key", "city_id"]
    if files:
        gold = gold.repartitionByRange(files, *place, "merchant_id", "purchase_ts")
    return gold.sortWithinPartitions(*place)


def read_gold(spark: SparkSession, root: str) -> DataFrame:
    """The Gold table under ``root``, columns in their documented order."""
    return read_layer_table(spark, T_GOLD_TRANSACTIONS, root, GOLD_COLUMNS)


_RUNNERS = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold}


def run_layers(spark: SparkSession, paths: LayerPaths, layers: Iterable[str] = ("all",), resume: bool = False) -> list[str]:
    """Run the chosen layers in canonical order; returns the layers asked for.

    With ``resume`` a table is written only if its inputs (source files, runs
    of the layer below, settings it depends on) are not those its current run
    was made from: a call repeated after a failure goes on where it ended.
    """
    chosen = resolve_layers(layers)
    for layer in chosen:
        _RUNNERS[layer](spark, paths, resume)
    return chosen


def stage_testdata_sources(
    spark: SparkSession, sf_dir: str, landing: str, catalog_prefix: str = ""
) -> LayerPaths:
    """Land the adapter-derived raw sources as files, as a source system would.

    Merchants become a 20-column header CSV, transactions a parquet folder;
    layer tables go under ``{landing}/warehouse``.
    """
    csv_path = f"{landing}/raw/merchants_csv"
    pq_path = f"{landing}/raw/transactions"
    _run_together(
        lambda: write_merchants_csv(raw_merchants_csv_layout(raw_merchants(spark, sf_dir)), csv_path),
        lambda: write_parquet(raw_transactions(spark, sf_dir), pq_path),
    )
    return LayerPaths(csv_path, pq_path, f"{landing}/warehouse", catalog_prefix=catalog_prefix)


@contextmanager
def testdata_layers(spark: SparkSession, sf_dir: str, layers: Iterable[str]) -> Iterator[LayerPaths]:
    """The test sources landed and ``layers`` built, all removed again afterwards.

    Names and files belong to this call alone.  What is to outlive it must be
    taken out with :func:`kept_table` or written elsewhere (its files are then
    the session's).
    """
    run = uuid.uuid4().hex[:12]
    landing = f"{shared_dir(spark)}/layers-{run}"
    paths = stage_testdata_sources(spark, sf_dir, landing, catalog_prefix=f"t{run}_")
    try:
        run_layers(spark, paths, layers)
        yield paths
    finally:
        drop_namespaces(spark, landing, paths.catalog_prefix)


def kept_table(spark: SparkSession, table: str, root: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A layer table that outlives the layers: its files are moved out of ``root``, not copied."""
    kept = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex[:12]}"
    schema = read_layer_table(spark, table, root, columns).schema
    move_files(spark, table_location(spark, table, root), kept)
    return spark.read.schema(schema).parquet(kept)


def layer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage sources, run all layers, and read the Gold table back."""
    with testdata_layers(spark, sf_dir, ["all"]) as paths:
        return kept_table(spark, T_GOLD_TRANSACTIONS, paths.root, GOLD_COLUMNS)


def bronze_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A Bronze table as landed from its source file (CSV or parquet) and written."""
    with testdata_layers(spark, sf_dir, ["bronze"]) as paths:
        return kept_table(spark, table, paths.root)


def written_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the five layer tables, as counted by their writes: no table is scanned."""
    names = (T_BRONZE_MERCHANTS, T_SILVER_MERCHANTS, T_BRONZE_TRANSACTIONS, T_SILVER_TRANSACTIONS, T_GOLD_TRANSACTIONS)
    with testdata_layers(spark, sf_dir, ["all"]) as paths:
        counted = [(name, run_metrics(spark, name, paths.root)["rows"]) for name in names]
    return spark.createDataFrame(counted, "layer_table string, row_count long")


def written_fanout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and Gold rows, and how Gold's rows are named, as counted by the writes."""
    with testdata_layers(spark, sf_dir, ["all"]) as paths:
        silver, gold = (run_metrics(spark, name, paths.root) for name in (T_SILVER_TRANSACTIONS, T_GOLD_TRANSACTIONS))
    row = (silver["rows"], gold["rows"], gold["named"], gold["unnamed"])
    return spark.createDataFrame([row], "silver_rows long, gold_rows long, named long, unnamed long")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage sources, build Silver in batch, stream transactions into Gold.

    Runs the incremental query to completion (``availableNow``) and reads the
    sink back; the result equals the batch Gold table.
    """
    from ..streaming import IncrementalGold, start_incremental_gold

    kept = f"{shared_dir(spark)}/kept-{uuid.uuid4().hex[:12]}"  # the sink outlives the layers
    with testdata_layers(spark, sf_dir, ["bronze", "silver"]) as paths:
        cfg = IncrementalGold(
            transactions_dir=paths.transactions_parquet,
            gold_path=kept,
            checkpoint=f"{paths.root}/checkpoints/gold_stream",
        )
        query = start_incremental_gold(spark, cfg, read_layer_table(spark, T_SILVER_MERCHANTS, paths.root))
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"incremental gold failed: {query.exception()}")
    return spark.read.parquet(kept).select(*GOLD_COLUMNS)
