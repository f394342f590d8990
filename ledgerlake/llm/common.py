"""Pieces the operators share: reading, written intermediates, components."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run (once per context)."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it came from a shipped archive already
        archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-"), "ledgerlake-package.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.relpath(full, os.path.dirname(package)))
        context.addPyFile(archive)
    context._ledgerlake_shipped = True


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id long, text string) of ``docs``; other columns, whatever their names, are left out."""
    ship(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the session's shared folder."""
    return f"{shared_dir(spark)}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a written table in the shared folder: its lineage ends there.

    A lost executor re-reads files instead of repeating the work before.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, tag)
    df.write.parquet(path)
    release_shuffles(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished queries now.

    It does so when the driver's garbage collector finds their plans unused,
    which on a large heap can take very long.  The listener threads hold the
    last finished query until the next one, so a trivial one comes first.
    """
    spark.range(1).count()
    time.sleep(0.1)
    spark._jvm.System.gc()


def discard(table: DataFrame) -> None:
    """Delete the files of a :func:`written` table that nothing reads any more."""
    remove(table.sparkSession, table.written_path)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column (null: empty)."""
    column = pc.fill_null(column.cast(pa.binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    if n == 0 or data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int):
    """``batch`` in runs of rows holding about ``most_bytes`` of text each."""
    _, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    at, n = 0, batch.num_rows
    while at < n:
        upto = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
        upto = min(max(upto, at + 1), n)
        yield batch.slice(at, upto - at)
        at = upto


def connected_components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component = its smallest node.

    Alternating large-star and small-star steps: each node's smallest
    neighbour is a pre-aggregated minimum, so a node with very many links
    never gathers them in one task.  Every round is written to the shared
    folder; the driver sees only a row count and two sums of 64-bit hashes
    per round, which end the rounds when none changes.
    """
    def hang(sym: DataFrame) -> DataFrame:
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return sym.join(least, "u")

    def sign(df: DataFrame) -> tuple:
        whole = [F.sum(F.xxhash64(*pair).cast("decimal(20,0)")) for pair in (("a", "b"), ("b", "a"))]
        return tuple(df.agg(F.count("*"), *whole).first())

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    links = links.distinct().checkpoint()
    before = sign(links)
    while before[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = hang(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        links = small.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct().checkpoint()
        after = sign(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
