"""Repeated strings: what a task holds at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerlake.llm import suffix_dedup


def test_buckets_are_judged_a_few_at_a_time(monkeypatch):
    """Whole buckets, but not a whole batch of them: a context's strings are 200 rows of several arrays."""
    sizes, judged = [], suffix_dedup.repeated_in_buckets

    def counted(rows, length):
        sizes.append(rows.num_rows)
        return judged(rows, length)

    monkeypatch.setattr(suffix_dedup, "repeated_in_buckets", counted)
    bucket = np.repeat(np.arange(3000), 2)
    texts = [f"{i:05d}".encode() + b"x" * 15 for i in bucket]
    rows = pa.record_batch([pa.array(bucket), pa.array(np.arange(6000)), pa.array(np.zeros(6000, np.int64)), pa.array(np.zeros(6000, np.int64)),
                            pa.array(np.full(6000, 3)), pa.array(texts, pa.binary())], names=["bucket", "doc_id", "mark", "begin", "at", "bytes"])
    runs = [r for b in suffix_dedup._bucket_rows(20)([rows.slice(0, 2501), rows.slice(2501)]) for r in b.to_pylist()]
    assert max(sizes) <= suffix_dedup.HELD_CONTEXTS and sum(sizes) == 6000
    assert sorted(r["doc_id"] for r in runs) == list(range(6000)) and {(r["lo"], r["hi"]) for r in runs} == {(0, 20)}


def test_a_bucket_stays_whole():
    bucket = np.array([1, 1, 2, 3, 3, 3, 3, 4])
    assert list(suffix_dedup.bucket_groups(bucket, 3)) == [(0, 3), (3, 7), (7, 8)]
    assert list(suffix_dedup.bucket_groups(bucket[:0], 3)) == []


def test_open_contexts_leave_in_small_batches():
    """Documents with many open contexts do not gather."""
    text = "ab" * 3000
    open_ = [{"place": p, "bucket": 1, "hot": True} for p in range(0, 5000, 10)]
    fields = pa.struct([("place", pa.int64()), ("bucket", pa.int64()), ("hot", pa.bool_())])
    rows = pa.record_batch([pa.array(range(40)), pa.array(range(40)), pa.array([text] * 40), pa.array([[]] * 40, pa.list_(pa.int64())),
                            pa.array([open_] * 40, pa.list_(fields))], names=["doc_id", "mark", "text", "shared", "open"])
    suffix_dedup_task = suffix_dedup.TaskContext
    try:
        suffix_dedup.TaskContext = type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())})
        out = list(suffix_dedup._open_rows(200, 32)([rows]))
    finally:
        suffix_dedup.TaskContext = suffix_dedup_task
    assert sum(b.num_rows for b in out) == 40
    assert max(sum(len(p) for p in b.column(3).to_pylist()) for b in out) <= suffix_dedup.HELD_CONTEXTS + len(open_)
    assert len({p["ctx"] for b in out for r in b.column(3).to_pylist() for p in r}) == 40 * len(open_)
