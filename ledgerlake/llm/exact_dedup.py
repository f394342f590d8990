"""Operator 5: exact dedup as a Grace hash join of a table with itself.

Level 0 runs beside the scan: every task keeps an open-addressing table of the
contents it has met, compares complete contents on a hash match, and spills one
record per distinct content (with the ids that have it) to a written table in
the shared folder.  A text that makes up a third of all rows therefore leaves
one record per task.  The records are then partitioned by a hash of their
content, a bucket a task, into the same kind of table; what doesn't fit a
bucket's table is written out and partitioned again under another hash seed,
until nothing is left.  A group is decided only in a bucket that has seen all
its records, and the first content always fits, so every level makes progress.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, text_rows, written

# Content bytes a task's table may hold, and ids it may collect before it spills.
TABLE_BYTES = 96 << 20
TABLE_IDS = 200_000
BUCKET_BYTES = 48 << 20


class ContentTable:
    """Open addressing with linear probing; equal hashes are settled by the contents."""

    def __init__(self, most_bytes: int):
        self.most_bytes = most_bytes
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def _grow(self) -> None:
        size = len(self.slots) * 4
        slots = [-1] * size
        for entry, h in enumerate(self.hashes):
            at = h & (size - 1)
            while slots[at] >= 0:
                at = (at + 1) & (size - 1)
            slots[at] = entry
        self.slots = slots

    def entry(self, content: bytes) -> int:
        """The content's entry, new if need be; -1 if it is new and the table is full."""
        h = xxhash.xxh64_intdigest(content, 5)
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (entry := slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            at = (at + 1) & mask
        if self.contents and self.bytes + len(content) > self.most_bytes:
            return -1
        entry = slots[at] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry


_SPILL = pa.schema([("rep", pa.int64()), ("keep", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("text", pa.string())])
_LEVEL = pa.schema([("rep", pa.int64()), ("keep_id", pa.int64()), ("keeper", pa.bool_()), ("group_size", pa.int64()), ("text_sha256", pa.string()),
                    ("keep", pa.int64()), ("n", pa.int64()), ("text", pa.string())])


def _largest(ids: list) -> int | None:
    return max((i for i in ids if i is not None), default=None)


def _fold(table_bytes: int):
    """Level 0: (doc_id, text) -> a record per distinct content of a table's filling."""
    def run(batches):
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        table, ids, held = ContentTable(table_bytes), [], 0

        def spill():
            nonlocal made, ids, held
            for a in range(0, len(ids), 256):
                own, texts = ids[a : a + 256], [c.decode("utf-8", "surrogatepass") for c in table.contents[a : a + 256]]
                reps = [(task << 40) | (made + k) for k in range(len(own))]
                made += len(own)
                yield pa.record_batch([reps, [_largest(i) for i in own], [len(i) for i in own], own, texts], schema=_SPILL)
            table.clear()
            ids, held = [], 0

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for key, text in zip(batch.column(0).to_pylist(), texts):
                content = text.as_py() or b""
                entry = table.entry(content)
                if entry < 0 or held >= TABLE_IDS:
                    yield from spill()
                    entry = table.entry(content)
                if entry == len(ids):
                    ids.append([])
                ids[entry].append(key)
                held += 1
        yield from spill()

    return run


def _resolve(table_bytes: int):
    """One bucket: decided records without text, and those that didn't fit with theirs."""
    def run(batches):
        table = ContentTable(table_bytes)
        members: list[list[int]] = []  # records of each content
        best, first, size = [], [], []  # largest id, the record that has it, rows
        for batch in batches:
            left = []
            texts = batch.column(3).cast(pa.binary())
            for rep, keep, n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), texts):
                entry = table.entry(text.as_py())
                if entry < 0:
                    left.append((rep, None, None, None, None, keep, n, text.as_py().decode("utf-8", "surrogatepass")))
                    continue
                if entry == len(members):
                    members.append([])
                    best.append(None)
                    first.append(rep)
                    size.append(0)
                members[entry].append(rep)
                known = best[entry]
                if (keep is not None and (known is None or keep > known)) or (keep == known and rep < first[entry]):
                    best[entry], first[entry] = keep, rep
                size[entry] += n
            if left:
                yield pa.record_batch([list(c) for c in zip(*left)], schema=_LEVEL)
        rows = []
        for reps, keep, keeper, n, content in zip(members, best, first, size, table.contents):
            digest = hashlib.sha256(content).hexdigest()
            rows += [(rep, keep, rep == keeper, n, digest, None, None, None) for rep in reps]
            if len(rows) > 5000:
                yield pa.record_batch([list(c) for c in zip(*rows)], schema=_LEVEL)
                rows = []
        if rows:
            yield pa.record_batch([list(c) for c in zip(*rows)], schema=_LEVEL)

    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Equal texts form a group; the row with the largest ``doc_id`` stays, one
    of them if it is repeated.  Null text counts as empty.  A null id never
    stays while the group has another; if it has none, one row stays.  Empty
    table: no rows.  Other columns are not read.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    spilled = written(rows.mapInArrow(_fold(table_bytes), "rep long, keep long, n long, ids array<long>, text string"), "grace0")
    fields = "rep long, keep_id long, keeper boolean, group_size long, text_sha256 string, keep long, n long, text string"
    tables, decided, level, left = [spilled], [], 1, spilled.select("rep", "keep", "n", "text")
    while True:
        found = left.agg(F.sum(F.octet_length("text") + 200)).first()[0]
        if not found:
            break
        buckets = -(-found // bucket_bytes)
        dealt = left.withColumn("b", F.xxhash64("text", F.lit(level))).repartition(buckets, "b").drop("b")
        done = written(dealt.mapInArrow(_resolve(table_bytes), fields), f"grace{level}")
        tables.append(done)
        decided.append(done.where("text is null").select("rep", "keep_id", "keeper", "group_size", "text_sha256"))
        left, level = done.where("text is not null").select("rep", "keep", "n", "text"), level + 1
    if not decided:
        return docs.sparkSession.createDataFrame([], "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string")
    groups = decided[0]
    for more in decided[1:]:
        groups = groups.unionAll(more)
    joined = spilled.select("rep", "ids").join(groups, "rep")
    stays = F.expr("if(keeper, coalesce(array_position(ids, keep_id) - 1, 0), -1)")
    rows = joined.select("keep_id", "group_size", "text_sha256", stays.alias("at"), F.posexplode("ids").alias("pos", "doc_id"))
    out = written(rows.select("doc_id", "keep_id", "group_size", F.expr("pos = at").alias("kept"), "text_sha256"), "copies")
    for table in tables:
        discard(table)
    return out


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
