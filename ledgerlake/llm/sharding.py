"""Operator 7: jump consistent hashing of stable keys to shards.

A key's shard depends on the key and the number of shards alone; there is no
ring table, and one more shard takes over only the rows that move into it.
Rows are numbered within their shard without moving them: every scan task
counts its own rows per shard, the counts (tasks x shards numbers) are summed
ahead, and a row's slot is its task's offset plus its place in the task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, ship, written

SHARDS = 8
# Multiplier and increment of the published jump hash.
_MULTIPLIER, _INCREMENT = np.uint64(2862933555777941757), np.uint64(1)


def jump_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every unsigned 64-bit key; about ln(shards) rounds over the keys still jumping."""
    state = keys.astype(np.uint64)
    at = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    ahead = np.zeros(len(state), np.int64)
    with np.errstate(over="ignore"):
        while len(going):
            at[going] = ahead[going]
            state[going] = state[going] * _MULTIPLIER + _INCREMENT
            draw = ((state[going] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
            ahead[going] = ((at[going] + 1) * (float(1 << 31) / draw)).astype(np.int64)
            going = going[ahead[going] < shards]
    return at


def place_rows(rows: DataFrame, shards: int, key_col: str = "key") -> DataFrame:
    """``rows`` with shard, grown_shard (with one shard more) and slot (gapless from 0 per shard).

    ``key_col`` is a 64-bit number; a null key counts as 0.  Equal keys share
    a shard and take a slot each.  Slots follow no order.
    """
    ship(rows.sparkSession)
    fields = rows.schema.fields

    def run(batches):
        from pyspark import TaskContext

        task, filled = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            key = batch.column(batch.schema.get_field_index(key_col)).fill_null(0).to_numpy().view(np.uint64)
            shard = jump_shards(key, shards)
            order = np.argsort(shard, kind="stable")
            many = np.bincount(shard, minlength=shards)
            first = np.concatenate([[0], np.cumsum(many)[:-1]])
            place = np.empty(len(key), np.int64)
            place[order] = np.arange(len(key)) - first[shard[order]]
            place += filled[shard]
            filled += many
            yield pa.record_batch([*batch.columns, pa.array(shard, pa.int32()), pa.array(jump_shards(key, shards + 1), pa.int32()),
                                   pa.array(np.full(len(key), task), pa.int32()), pa.array(place)],
                                  names=[*batch.schema.names, "shard", "grown_shard", "task", "place"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    placed = written(rows.mapInArrow(run, f"{schema}, shard int, grown_shard int, task int, place long"), "placed")
    counts = placed.groupBy("task", "shard").agg(F.max("place").alias("last"))
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "shard", F.coalesce(F.sum(F.col("last") + 1).over(before), F.lit(0)).alias("offset"))
    joined = placed.join(offsets, ["task", "shard"])
    return joined.withColumn("slot", F.col("offset") + F.col("place")).drop("task", "place", "offset")


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Law ``key``: doc_id and the number of shards decide.  Size: UTF-8 bytes of
    the text plus 1 (null text: none, so 1, and the checksum of no bytes).
    Null ids: all in the shard of one fixed key.  Repeated rows: same shard, a
    slot each.  Empty table: no rows.  Other columns are not read.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = place_rows(rows.withColumn("key", F.xxhash64("doc_id")), shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))
