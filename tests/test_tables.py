"""Versioned runs: writers side by side, pinned readers, kept runs, counts taken while writing."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.session import shared_dir
from ledgerlake.sources import tables

TABLE = "gold.shared"


@pytest.fixture()
def root(spark):
    own = uuid.uuid4().hex[:8]
    path = f"{shared_dir(spark)}/tables-{own}"
    tables.ensure_namespaces(spark, path, f"v{own}_")
    yield path, f"v{own}_"
    tables.drop_namespaces(spark, path, f"v{own}_")


def rows_of(spark, writer, version, n=2000):
    return spark.range(n, numPartitions=3).select(F.lit(writer).alias("writer"), F.lit(version).alias("version"))


def test_two_writers_and_a_reader(spark, root):
    path, prefix = root
    tables.overwrite_table(rows_of(spark, "first", 0), TABLE, path, prefix=prefix)
    errors, seen, stop = [], [], threading.Event()

    def write(name):
        try:
            for version in range(4):
                tables.overwrite_table(rows_of(spark, name, version), TABLE, path, prefix=prefix)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    def read():
        try:
            while not stop.is_set():
                df = tables.read_layer_table(spark, TABLE, path)
                time.sleep(0.3)  # the table moves on meanwhile
                seen.append([tuple(r) for r in df.groupBy("writer", "version").count().collect()])
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    reader, writers = threading.Thread(target=read), [threading.Thread(target=write, args=(w,)) for w in "ab"]
    for thread in (reader, *writers):
        thread.start()
    for thread in writers:
        thread.join()
    stop.set()
    reader.join()
    assert not errors, errors
    assert seen and all(len(found) == 1 and found[0][2] == 2000 for found in seen)
    runs = tables.table_runs(spark, TABLE, path)
    assert len(runs) == len(set(runs)) == 9
    kept = {tuple(tables.read_layer_table(spark, TABLE, path, run=run).first()) for run in runs}
    assert kept == {("first", 0), *((w, v) for w in "ab" for v in range(4))}
    last = tables.read_layer_table(spark, TABLE, path, run=runs[-1]).first()
    assert tables.read_layer_table(spark, TABLE, path).first() == spark.read.table(f"{prefix}{TABLE}").first() == last


def test_the_writer_that_ends_last_is_current(spark, root):
    path, prefix = root

    def slowly(batches):
        time.sleep(4)
        yield from batches

    slow = rows_of(spark, "slow", 1).coalesce(1).mapInArrow(slowly, "writer string, version int")
    thread = threading.Thread(target=tables.overwrite_table, args=(slow, TABLE, path), kwargs={"prefix": prefix})
    thread.start()
    time.sleep(1)
    tables.overwrite_table(rows_of(spark, "fast", 1), TABLE, path, prefix=prefix, keep_seconds=0)
    assert tables.read_layer_table(spark, TABLE, path).first().writer == "fast"
    thread.join()
    assert tables.read_layer_table(spark, TABLE, path).first().writer == "slow"
    assert len(tables.table_runs(spark, TABLE, path)) == 2


def test_replaced_runs_go_after_their_time(spark, root):
    path, prefix = root
    for version in range(3):
        tables.overwrite_table(rows_of(spark, "w", version, 10), TABLE, path, prefix=prefix)
    pinned = tables.read_layer_table(spark, TABLE, path)
    first = tables.table_runs(spark, TABLE, path)[0]
    tables.overwrite_table(rows_of(spark, "w", 3, 10), TABLE, path, prefix=prefix, keep_seconds=3600)
    assert len(tables.table_runs(spark, TABLE, path)) == 4 and pinned.first().version == 2
    time.sleep(1.1)
    tables.overwrite_table(rows_of(spark, "w", 4, 10), TABLE, path, prefix=prefix, keep_seconds=1)
    runs = tables.table_runs(spark, TABLE, path)
    assert first not in runs and len(runs) == 2  # version 3 was replaced just now
    with pytest.raises(FileNotFoundError):
        tables.read_layer_table(spark, TABLE, path, run=first)


def test_changed_columns(spark, root):
    path, prefix = root
    tables.overwrite_table(rows_of(spark, "w", 0, 10), TABLE, path, prefix=prefix)
    tables.overwrite_table(spark.range(4).toDF("other"), TABLE, path, prefix=prefix)
    assert spark.read.table(f"{prefix}{TABLE}").columns == ["other"]
    tables.overwrite_table(spark.range(6).selectExpr("id AS a", "id % 2 AS b"), TABLE, path, ["b"], prefix=prefix)
    tables.overwrite_table(spark.range(8).selectExpr("id AS a", "id % 4 AS b"), TABLE, path, ["b"], prefix=prefix)
    assert spark.read.table(f"{prefix}{TABLE}").count() == 8


def test_counts_are_taken_by_the_write(spark, root):
    """Each row once, behind a shuffle, and without another pass over them."""
    path, prefix = root
    scans = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            scans.add(batch.num_rows)
            yield batch

    df = spark.range(1000, numPartitions=4).mapInArrow(counted, "id long").repartition(3)
    tables.overwrite_table(df, TABLE, path, prefix=prefix, counts={"even": F.count_if(F.col("id") % 2 == 0)})
    assert tables.run_metrics(spark, TABLE, path) == {"rows": 1000, "even": 500} and scans.value == 1000
    tables.overwrite_table(spark.range(0), TABLE, path, prefix=prefix)
    assert tables.run_metrics(spark, TABLE, path) == {"rows": 0}


def test_bucketed_run_joins_without_a_shuffle(spark, root):
    path, prefix = root
    facts = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "id AS v")
    sides = facts.select("k").distinct().selectExpr("k", "length(k) AS size")
    tables.overwrite_table(facts, "silver.facts", path, prefix=prefix, bucket_by=("k", 4))
    tables.overwrite_table(sides, "silver.sides", path, prefix=prefix, bucket_by=("k", 4))
    left, right = (tables.read_bucketed_table(spark, name, path) for name in ("silver.facts", "silver.sides"))
    both = left.hint("merge").join(right, "k", "left")
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert both.count() == 3000 and both.where("size IS NULL").count() == 0
    assert tables.run_metrics(spark, "silver.facts", path)["rows"] == 3000


def test_counts_with_a_task_that_is_repeated():
    """The first attempt of a task fails after most of its rows: each row is still counted once."""
    code = """
import sys, uuid
from pyspark import TaskContext
from pyspark.sql import SparkSession
from ledgerlake.sources import tables
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
def failing(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost")
tables.ensure_namespaces(spark, sys.argv[1])
tables.overwrite_table(spark.range(900, numPartitions=3).mapInArrow(failing, "id long"), "gold.t", sys.argv[1])
assert tables.run_metrics(spark, "gold.t", sys.argv[1]) == {"rows": 900}
assert tables.read_layer_table(spark, "gold.t", sys.argv[1]).count() == 900
"""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.TemporaryDirectory() as folder:
        env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"PYTHONPATH": repo}
        said = subprocess.run([sys.executable, "-c", code, f"{folder}/root"], cwd=folder, env=env, capture_output=True, text=True, timeout=200)
    assert said.returncode == 0, said.stderr[-2000:]
