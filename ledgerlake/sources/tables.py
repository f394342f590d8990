"""Layered tables ``bronze.* / silver.* / gold.*``: versioned runs of parquet files under a root.

A refresh writes a new run folder, ``{root}/{namespace}/{table}/run-{id}``, and
only then makes it the table's current rows by creating one empty file,
``_versions/{number}-run-{id}``: the entry with the highest name is the table.
Creating a file is atomic on every file system, numbers are taken after the
write has ended, and no clock is asked, so of two writers the one that ends
last is current, and both runs stay.  A write that fails leaves the table as it
was and removes its own files.

A reader is pinned to the run it found when its DataFrame was made; a run that
has been replaced is kept for ``keep_seconds`` after that (by the file
system's own times), so no running read loses its files, and ``run=`` reads an
earlier one.  A run may keep partitions of earlier runs (``overwrite_partitions``);
those stay while a version that is kept refers to them.  Any process that knows ``root`` finds the table without a
catalog; the session catalog is pointed at the current run as well, for SQL by
name.  Row counts are taken while a run is written (``run_metrics``).  ``root``
is a folder every executor can reach (normally ``shared_dir(spark)``).
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NAMESPACES = ("bronze", "silver", "gold")

# The table names of each layer.
T_BRONZE_MERCHANTS = "bronze.merchants"
T_BRONZE_TRANSACTIONS = "bronze.transactions"
T_SILVER_MERCHANTS = "silver.merchants"
T_SILVER_TRANSACTIONS = "silver.transactions"
T_GOLD_TRANSACTIONS = "gold.transactions_enriched"
T_GOLD_ROLLUP = "gold.sales_rollup"
T_GOLD_EVIDENCE = "gold.merchant_evidence"

_RUN, _VERSIONS, _ELSEWHERE, _METRICS, _BUCKETS, _INPUTS, _PARTS = (
    "run-", "_versions", "_location", "_metrics", "_buckets", "_inputs", "_parts")

# How long a replaced run stays readable, and after how long a run folder that
# never became a version (its writer was killed) counts as abandoned.
KEEP_SECONDS = 24 * 3600.0
ABANDONED_SECONDS = 7 * 24 * 3600.0

# Fixed value: how the file layout spells a NULL partition.
_NULL_PART = "__HIVE_DEFAULT_PARTITION__"

_catalog = threading.Lock()


def table_path(root: str, table: str) -> str:
    namespace, name = table.split(".", 1)
    return f"{root}/{namespace}/{name}"


def qualified(table: str, prefix: str = "") -> str:
    """``bronze.merchants`` → ``{prefix}bronze.merchants`` (own namespaces per prefix)."""
    return f"{prefix}{table}"


class _Files:
    """The few file operations needed, through Spark's own file systems (driver only)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path_of = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def listed(self, path: str) -> dict[str, int]:
        """Names in a folder with their modification times (ms, the file system's own); empty if there is none."""
        target = self.path_of(path)
        if not self.fs.exists(target):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(target)}

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path_of(path))

    def remove(self, path: str) -> None:
        self.fs.delete(self.path_of(path), True)

    def move(self, path: str, target: str) -> None:
        if not self.fs.rename(self.path_of(path), self.path_of(target)):
            raise OSError(f"cannot move {path} to {target}")

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.path_of(path), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, path: str) -> str:
        file = self.fs.open(self.path_of(path))
        try:
            return bytes(file.readAllBytes()).decode()
        finally:
            file.close()


def _new_run(root: str, table: str) -> str:
    return f"{table_path(root, table)}/{_RUN}{uuid.uuid4().hex[:16]}"


def _versions(files: _Files, path: str) -> list[tuple[int, str, int]]:
    """(number, run, time it became current), oldest first."""
    entries = sorted(files.listed(f"{path}/{_VERSIONS}").items())
    return [(int(name.split("-", 1)[0]), name.split("-", 1)[1], since) for name, since in entries if _RUN in name]


def table_runs(spark: SparkSession, table: str, root: str) -> list[str]:
    """Names of the table's readable runs, oldest first; the last is current."""
    path = table_path(root, table)
    return [run for _, run, _ in _versions(_Files(spark, path), path)]


def _run_path(spark: SparkSession, table: str, root: str, run: str | None) -> str:
    runs = table_runs(spark, table, root)
    if not runs or run not in (None, *runs):
        raise FileNotFoundError(f"{table} has no {'run ' + run if run else 'finished run'} under {table_path(root, table)}")
    return f"{table_path(root, table)}/{run or runs[-1]}"


def table_location(spark: SparkSession, table: str, root: str, run: str | None = None) -> str:
    """Where the rows of the table's current run (or of ``run``) are; FileNotFoundError if there is none."""
    found = _run_path(spark, table, root, run)
    files = _Files(spark, found)
    pointer = f"{found}/{_ELSEWHERE}"
    return files.read(pointer) if files.exists(pointer) else found


def run_metrics(spark: SparkSession, table: str, root: str, run: str | None = None) -> dict[str, int]:
    """What was counted while the current run (or ``run``) was written: ``rows``, and the writer's own counts."""
    found = f"{_run_path(spark, table, root, run)}/{_METRICS}"
    files = _Files(spark, found)
    return json.loads(files.read(found)) if files.exists(found) else {}


def run_inputs(spark: SparkSession, table: str, root: str, run: str | None = None) -> dict:
    """What the current run (or ``run``) says it was made from; empty if it says nothing or there is no run."""
    try:
        found = f"{_run_path(spark, table, root, run)}/{_INPUTS}"
    except FileNotFoundError:
        return {}
    files = _Files(spark, found)
    return json.loads(files.read(found)) if files.exists(found) else {}


def source_state(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Size and modification time of every file under a source path, by name (for ``inputs``)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(target, True)
    state = {}
    while found.hasNext():
        file = found.next()
        state[file.getPath().toString()] = [file.getLen(), file.getModificationTime()]
    return state


def move_files(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder to ``target``, a new name in an existing folder of the same file system."""
    _Files(spark, path).move(path, target)


def ensure_namespaces(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Create the three layer namespaces (located under ``root``) if absent."""
    for ns in NAMESPACES:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {prefix}{ns} LOCATION '{root}/{ns}'")


def drop_namespaces(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Forget the layer namespaces of ``prefix`` and remove all files under ``root``."""
    for ns in NAMESPACES:
        spark.sql(f"DROP NAMESPACE IF EXISTS {prefix}{ns} CASCADE")
    _Files(spark, root).remove(root)


def _switch(spark: SparkSession, table: str, root: str, run: str, prefix: str, keep_seconds: float) -> None:
    """Make ``run`` the current version, point the catalog at the table, remove what no reader may still hold."""
    path = table_path(root, table)
    files = _Files(spark, path)
    known = _versions(files, path)
    number = known[-1][0] + 1 if known else 1
    files.write(f"{path}/{_VERSIONS}/{number:012d}-{run.rsplit('/', 1)[1]}", "")
    with _catalog:
        current = _run_path(spark, table, root, None)
        _point_catalog(spark, qualified(table, prefix), table_location(spark, table, root), _stored_parts(files, current))
    _remove_replaced(files, path, keep_seconds)


def _stored_parts(files: _Files, run: str) -> dict[str, str]:
    """Partition folder → run that holds it, for a run that keeps partitions of others."""
    return json.loads(files.read(f"{run}/{_PARTS}")) if files.exists(f"{run}/{_PARTS}") else {}


def _point_catalog(spark: SparkSession, name: str, location: str, parts: dict[str, str]) -> None:
    """The catalog's table at ``location``, moved there in one step where the columns stay the same."""
    if parts:
        table, base = spark.read.parquet(location), location.rsplit("/", 1)[0]
        column = next(iter(parts)).split("=", 1)[0]
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{location}'")
        for part, run in parts.items():
            value = part.split("=", 1)[1]
            value = "NULL" if value == _NULL_PART else f"'{value}'"
            spark.sql(f"ALTER TABLE {name} ADD PARTITION (`{column}`={value}) LOCATION '{base}/{run}/{part}'")
        return
    if spark.catalog.tableExists(name):
        columns = spark.catalog.listColumns(name)
        if not any(c.isPartition for c in columns) and spark.read.parquet(location).schema == spark.read.table(name).schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=location, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def _remove_replaced(files: _Files, path: str, keep_seconds: float) -> None:
    """Remove runs replaced at least ``keep_seconds`` ago, and abandoned ones."""
    versions = _versions(files, path)
    now = max(since for *_, since in versions)
    old = [(number, run) for (number, run, _), (_, _, until) in zip(versions, versions[1:]) if now - until >= keep_seconds * 1000]
    kept = {run for _, run, _ in versions} - {run for _, run in old}
    kept |= {of for run in kept for of in _stored_parts(files, f"{path}/{run}").values()}
    for number, run in old:
        files.remove(f"{path}/{_VERSIONS}/{number:012d}-{run}")
        if run not in kept:
            files.remove(f"{path}/{run}")
    for name, changed in files.listed(path).items():  # without a version: abandoned, or outlived by a version that kept parts of it
        if name.startswith(_RUN) and name not in kept and now - changed >= ABANDONED_SECONDS * 1000:
            files.remove(f"{path}/{name}")


def overwrite_table(
    df: DataFrame, table: str, root: str, partition_by: Sequence[str] = (), prefix: str = "",
    keep_seconds: float = KEEP_SECONDS, counts: dict[str, Column] | None = None, bucket_by: tuple[str, int] | None = None,
    inputs: dict | None = None, options: dict[str, str] | None = None,
) -> None:
    """Replace ``table`` by ``df``: write a new run, then make it current.

    If the write fails, the table keeps its rows and the run's files are
    removed.  ``partition_by`` lays the files out in one folder per value;
    ``bucket_by`` (column, buckets) deals them out by a hash of a column,
    sorted by it, so that joins on it read them without a shuffle.  Rows,
    and the aggregates named in ``counts``, are counted by the write itself.
    ``inputs`` is stored with the run (see :func:`run_inputs`); ``options``
    go to the parquet writer.
    """
    spark, run = df.sparkSession, _new_run(root, table)
    seen = Observation()
    measured = {"rows": F.count(F.lit(1)), **(counts or {})}
    if bucket_by:  # a bucket with very many rows is split over tasks, each writing a file of it
        df = df.hint("rebalance", bucket_by[1], bucket_by[0])
    writer = df.observe(seen, *[c.alias(name) for name, c in measured.items()]).write.options(**(options or {}))
    files = _Files(spark, run)
    try:
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writing = f"{qualified(table, prefix)}_{run.rsplit('-', 1)[1]}"
            writer.bucketBy(bucket_by[1], bucket_by[0]).sortBy(bucket_by[0]).option("path", run).format("parquet").saveAsTable(writing)
            spark.sql(f"DROP TABLE {writing}")  # external: the files stay
            files.write(f"{run}/{_BUCKETS}", json.dumps(bucket_by))
        else:
            writer.parquet(run)
        files.write(f"{run}/{_METRICS}", json.dumps({name: int(n or 0) for name, n in seen.get.items()}))
        if inputs is not None:
            files.write(f"{run}/{_INPUTS}", json.dumps(inputs, sort_keys=True))
    except BaseException:
        files.remove(run)
        raise
    _switch(spark, table, root, run, prefix, keep_seconds)


def table_parts(spark: SparkSession, table: str, root: str, run: str | None = None) -> dict[str, str]:
    """Partition folder (``column=value``) → run that holds it, of a table partitioned by one column."""
    found = _run_path(spark, table, root, run)
    files = _Files(spark, found)
    return _stored_parts(files, found) or {name: found.rsplit("/", 1)[1] for name in files.listed(found) if "=" in name}


def overwrite_partitions(
    df: DataFrame, table: str, root: str, column: str, values: Sequence, prefix: str = "",
    keep_seconds: float = KEEP_SECONDS, inputs: dict | None = None, options: dict[str, str] | None = None,
) -> None:
    """Replace the partitions ``values`` of ``column`` by ``df``'s rows (all of them of those partitions); the others stay as files.

    The new run holds the rewritten partitions and a list of where the others
    are, so it is a version like any other: earlier ones stay readable.
    """
    spark, run = df.sparkSession, _new_run(root, table)
    replaced = {f"{column}={_NULL_PART if v is None else v}" for v in values}
    parts = {part: of for part, of in table_parts(spark, table, root).items() if part not in replaced}
    files = _Files(spark, run)
    try:
        df.write.options(**(options or {})).partitionBy(column).parquet(run)
        own = {name: run.rsplit("/", 1)[1] for name in files.listed(run) if "=" in name}
        if strangers := set(own) - replaced:
            raise ValueError(f"rows of other partitions: {sorted(strangers)}")
        files.write(f"{run}/{_PARTS}", json.dumps(parts | own, sort_keys=True))
        rows = _read_parts(spark, table, root, parts | own).count()  # from the files' footers
        files.write(f"{run}/{_METRICS}", json.dumps({"rows": rows}))
        if inputs is not None:
            files.write(f"{run}/{_INPUTS}", json.dumps(inputs, sort_keys=True))
    except BaseException:
        files.remove(run)
        raise
    _switch(spark, table, root, run, prefix, keep_seconds)


def _read_parts(spark: SparkSession, table: str, root: str, parts: dict[str, str]) -> DataFrame:
    """The partitions of each run, one scan per run."""
    scans = []
    for run in sorted(set(parts.values())):
        base = f"{table_path(root, table)}/{run}"
        scans.append(spark.read.option("basePath", base).parquet(*[f"{base}/{part}" for part, of in parts.items() if of == run]))
    return reduce(DataFrame.unionByName, scans)


def register_external_parquet(spark: SparkSession, table: str, location: str, root: str, prefix: str = "",
                              keep_seconds: float = KEEP_SECONDS, inputs: dict | None = None) -> None:
    """Make existing parquet files the current rows of ``table`` without copying them.

    The run folder then holds only the files' place; they stay where they are.
    """
    run = _new_run(root, table)
    _Files(spark, run).write(f"{run}/{_ELSEWHERE}", location)
    if inputs is not None:
        _Files(spark, run).write(f"{run}/{_INPUTS}", json.dumps(inputs, sort_keys=True))
    _switch(spark, table, root, run, prefix, keep_seconds)


def read_layer_table(
    spark: SparkSession, table: str, root: str, columns: Sequence[str] | None = None, run: str | None = None
) -> DataFrame:
    """Scan the table's current run, or ``run`` (lazy; pruning and pushdown reach the files).

    The DataFrame stays on that run, whatever is written afterwards.
    ``columns`` restores a column order (a partitioned table lists its
    partition columns last).
    """
    found = _run_path(spark, table, root, run)
    parts = _stored_parts(_Files(spark, found), found)
    df = _read_parts(spark, table, root, parts) if parts else spark.read.parquet(table_location(spark, table, root, run))
    return df.select(*columns) if columns else df


def read_bucketed_table(spark: SparkSession, table: str, root: str, run: str | None = None) -> DataFrame:
    """Like :func:`read_layer_table` for a run written with ``bucket_by``, its buckets known to the planner.

    Only a catalog tells Spark of buckets: the run gets an external entry of
    its own (``default.run_...``), from the bucket count stored with the run.
    """
    found = _run_path(spark, table, root, run)
    column, buckets = json.loads(_Files(spark, found).read(f"{found}/{_BUCKETS}"))
    name = "default." + found.rsplit("/", 1)[1].replace("-", "_")
    with _catalog:
        if not spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(found).schema.fields)
            spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({column}) SORTED BY ({column}) "
                      f"INTO {buckets} BUCKETS LOCATION '{found}'")
    return spark.read.table(name)
