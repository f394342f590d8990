"""Operator 2: token-id shards with a minimal perfect hash index.

A store is a folder of shards in ascending key order.  ``part-N.ids`` holds the
raw little-endian ids of the shard's documents one after the other and nothing
else; ``part-N.idx`` holds, per document, where its ids begin, and a minimal
perfect hash over the shard's keys (levels of bit arrays: a key that is alone
in its position of a level owns it, the others go on to the next; the rank of
the owned bit is the slot).  A slot stores a 32-bit fingerprint of its key,
the key's first document and how many it has, so a lookup takes a constant
number of steps and a key that isn't there is told by its fingerprint.

Every shard is written by one task, under a name of its own, then renamed: a
repeated or speculative task leaves the same file.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, scratch, slices, text_rows, utf8
from .word_tokens import WordTokens, vocabulary_path

DOCS_PER_SHARD = 16_384
BATCH_BYTES = 16 << 20
END_ID = 2
_MAGIC = b"IDSHARD1"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser (xor-shift and multiply) of integer keys under a seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: key -> 0..n-1."""

    GAMMA = 1.5

    def __init__(self, levels: list[np.ndarray]):
        """``levels``: one array of 64-bit words each."""
        self.levels = levels
        self.sizes = [len(w) * 64 for w in levels]
        words = np.concatenate(levels) if levels else np.empty(0, np.uint64)
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.begin = np.concatenate([[0], np.cumsum([len(w) for w in levels])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, level = [], 1
        while len(keys):
            words = int(len(keys) * cls.GAMMA) // 64 + 1
            at = (mix(keys, level) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(at, minlength=words * 64) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys, level = keys[~alone[at]], level + 1
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; for a key that was not built in, any slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (mix(keys[open_], level + 1) % np.uint64(size)).astype(np.int64)
            word = self.begin[level] + (at >> 6)
            bit = (at & 63).astype(np.uint64)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[found]] & ((np.uint64(1) << bit[found]) - np.uint64(1))
            out[open_[found]] = self.before[word[found]] + np.bitwise_count(below)
            open_ = open_[~found]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0) >> np.uint64(32)).astype("<u4")


def build_index(keys: list[int | None], first_ids: np.ndarray, width: int) -> bytes:
    """Index bytes of a shard whose documents have ``keys`` (ascending, nulls first)."""
    nulls = sum(k is None for k in keys)
    known = np.array(keys[nulls:], np.int64)
    distinct, first, count = np.unique(known, return_index=True, return_counts=True)
    mph = PerfectHash.build(distinct)
    slot = mph.slots(distinct)
    prints, rows, many = np.zeros(len(slot), "<u4"), np.zeros(len(slot), "<u8"), np.zeros(len(slot), "<u4")
    prints[slot], rows[slot], many[slot] = fingerprints(distinct), first + nulls, count
    head = json.dumps({"width": width, "rows": len(keys), "nulls": nulls, "keys": len(slot), "levels": [len(w) for w in mph.levels]}).encode()
    return b"".join([_MAGIC, np.array([len(head)], "<u4").tobytes(), head, mph.words.astype("<u8").tobytes(),
                     rows.tobytes(), first_ids.astype("<u8").tobytes(), prints.tobytes(), many.tobytes()])


class Shard:
    """One opened shard: the index in memory, ids read by range."""

    def __init__(self, fs, path: str):
        with fs.open_input_stream(f"{path}.idx") as file:
            raw = file.read()
        if raw[:8] != _MAGIC:
            raise ValueError(f"{path}.idx is no shard index")
        size = int(np.frombuffer(raw, "<u4", 1, 8)[0])
        head, at = json.loads(raw[12 : 12 + size]), 12 + size
        self.width, self.nulls, self.rows = head["width"], head["nulls"], head["rows"]

        def array(kind, n):
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.hash = PerfectHash([array("<u8", n) for n in head["levels"]])
        self.row, self.first = array("<u8", head["keys"]), array("<u8", head["rows"] + 1)
        self.prints, self.many = array("<u4", head["keys"]), array("<u4", head["keys"])
        self.file = fs.open_input_file(f"{path}.ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key (0 where it isn't stored)."""
        slot = self.hash.slots(keys)
        known = slot >= 0
        known[known] = self.prints[slot[known]] == fingerprints(keys[known])
        return np.where(known, self.row[slot] if len(self.row) else 0, 0), np.where(known, self.many[slot] if len(self.many) else 0, 0)

    def ids(self, row: int) -> np.ndarray:
        lo, hi = int(self.first[row]), int(self.first[row + 1])
        return np.frombuffer(self.file.read_at((hi - lo) * self.width, lo * self.width), f"<u{self.width}")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write_store(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text", docs_per_shard: int = DOCS_PER_SHARD) -> list[dict]:
    """Encode every whole text, append ``end_id``, write the shards; returns the manifest.

    Null text: only the end id.  Null keys: first of all, found as None.  A
    repeated key: all its documents, ordered by text.  Empty table: a store
    without documents.  Other columns are not read.  The manifest has a row
    per shard (shard, low, high, rows, ids), as many as shards, never rows.
    """
    spark = docs.sparkSession
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)

    def run(batches):
        shard = TaskContext.get().partitionId()
        tokens = WordTokens.load(vocabulary)
        width = tokens.dtype.itemsize
        end = np.array([end_id], tokens.dtype).view(np.uint8)
        fs, root = _open(folder)
        own = f"{root}/{uuid.uuid4().hex}"
        keys: list[int | None] = []
        firsts, total = [np.zeros(1, np.int64)], 0
        with fs.open_output_stream(f"{own}.ids") as file:
            for batch in batches:
                for part in slices(batch, "text", BATCH_BYTES):
                    raw, first = tokens.encode_rows(*utf8(part.column(1)))
                    ends = (first[1:] * width).repeat(width)
                    file.write(np.insert(raw, ends, np.tile(end, part.num_rows)).tobytes())
                    firsts.append(total + first[1:] + np.arange(1, part.num_rows + 1))
                    total = int(firsts[-1][-1])
                    keys += part.column(0).to_pylist()
        if not keys:
            fs.delete_file(f"{own}.ids")
            return
        with fs.open_output_stream(f"{own}.idx") as file:
            file.write(build_index(keys, np.concatenate(firsts), width))
        for kind in ("ids", "idx"):
            fs.move(f"{own}.{kind}", f"{root}/part-{shard:05d}.{kind}")
        known = [k for k in keys if k is not None]
        yield pa.record_batch([[shard], [known[0] if known else None], [known[-1] if known else None], [len(keys)], [total]],
                              schema=pa.schema([("shard", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("rows", pa.int64()), ("ids", pa.int64())]))

    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    shards = max(1, -(-docs.select(id_col).count() // docs_per_shard))
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = [r.asDict() for r in ordered.mapInArrow(run, "shard long, low long, high long, rows long, ids long").collect()]
    manifest.sort(key=lambda r: r["shard"])
    with fs.open_output_stream(f"{root}/manifest.json") as file:
        file.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> list[dict]:
    fs, root = _open(folder)
    with fs.open_input_stream(f"{root}/manifest.json") as file:
        return json.loads(file.read())


def read_keys(keys: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Look every distinct key up: (doc_id, start, n_tokens, ids_crc32, ids binary of 32-bit ids).

    A key that isn't stored gives no row; a repeated one a row per stored
    document, a null key those stored without a key.
    """
    manifest = read_manifest(folder)
    names = np.array([m["shard"] for m in manifest])
    lows = np.array([m["low"] if m["low"] is not None else -(2**63) for m in manifest], np.int64)
    base = dict(zip(names.tolist(), np.concatenate([[0], np.cumsum([m["ids"] for m in manifest])]).astype(int).tolist()))
    out_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def route(batches):
        for batch in batches:
            key = batch.column(0)
            value = key.fill_null(-(2**63)).to_numpy()
            at = np.maximum(np.searchsorted(lows, value, "right") - 1, 0)
            yield pa.record_batch([key, pa.array(names[at] if len(names) else np.zeros(len(key), np.int64))], names=["doc_id", "shard"])

    def look(batches):
        fs, root = _open(folder)
        shard, opened = None, None
        for batch in batches:
            number = batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b or number[a] not in base:
                    continue
                if shard != number[a]:
                    shard, opened = number[a], Shard(fs, f"{root}/part-{number[a]:05d}")
                key = batch.column(0).slice(a, b - a)
                row, many = opened.find(key.fill_null(0).to_numpy())
                rows = []
                for k, r, n in zip(key.to_pylist(), row.tolist(), many.tolist()):
                    r, n = (0, opened.nulls) if k is None else (r, n)
                    for i in range(int(r), int(r) + int(n)):
                        raw = opened.ids(i).astype("<u4").tobytes()
                        rows.append((k, base[int(shard)] + int(opened.first[i]), len(raw) // 4, zlib.crc32(raw), raw))
                    if len(rows) >= 1000:
                        yield pa.record_batch([list(c) for c in zip(*rows)], schema=out_schema)
                        rows = []
                if rows:
                    yield pa.record_batch([list(c) for c in zip(*rows)], schema=out_schema)

    distinct = keys.select(keys[id_col].cast("long").alias("doc_id")).distinct()
    routed = distinct.mapInArrow(route, "doc_id long, shard long")
    placed = routed.repartition(max(1, len(manifest)), "shard").sortWithinPartitions("shard", "doc_id")
    return placed.mapInArrow(look, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the written files, each found through the index."""
    docs = documents(spark, sf_dir)
    folder = scratch(spark, "idstore")
    write_store(docs, folder, vocabulary_path())
    return read_keys(docs, folder).drop("ids")
