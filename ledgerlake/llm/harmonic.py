"""Operator 13: harmonic packing.

A piece of length L belongs to the class k = capacity // L (reciprocal
classes: lengths over capacity/(k+1), up to capacity/k), and a class's
sequence takes exactly k pieces.  Nothing else decides where a piece goes, so
every task fills its own sequences of every class as rows come by: no shuffle,
no state but the open sequence of each class (under capacity/L pieces of
length L).

Where documents may be cut, a document is cut into whole sequences and its
tail into capacity/2, capacity/4, ... as it fits: the largest length of each
of those classes.  With a capacity that is a power of two these fill their
sequences without a gap, and a task's last, partly filled sequence of such a
class is split by the binary digits of its piece count into sequences whose
fill is a power of two, which need no padding either.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .byte_tokens import BYTE_TOKENIZER, ByteTokens
from .common import documents, slices, text_rows, utf8
from .word_tokens import vocabulary_path

CAPACITY = 1024
END_ID = 0
BATCH_BYTES = 12 << 20
# Sequences of one task are numbered from its partition's number shifted by so many bits.
TASK_BITS = 40
FIELDS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def cut_lengths(tokens: np.ndarray, capacity: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece lengths of documents of ``tokens`` ids, document after document, and each piece's document.

    Whole sequences come first, then capacity/2, capacity/4, ... as long as at
    least ``least`` ids are left; fewer stay one piece.  ``least >= capacity``
    cuts only what is longer than a sequence.
    """
    sizes, counts, left = [np.full(len(tokens), capacity)], [tokens // capacity], tokens % capacity
    size = capacity >> 1
    while size >= max(1, least):
        sizes.append(np.full(len(tokens), size))
        counts.append(left // size)
        left = left % size
        size >>= 1
    sizes.append(left)
    counts.append((left > 0).astype(np.int64))
    sizes, counts = np.stack(sizes, 1), np.stack(counts, 1)
    return np.repeat(sizes.ravel(), counts.ravel()), np.repeat(np.arange(len(tokens)), counts.sum(1))


class HarmonicBins:
    """The open sequences of one task: ``add`` gives the rows of sequences that got full, ``close`` the rest.

    A row is a column of an int64 matrix whose line ``length`` is the piece's length.
    """

    def __init__(self, capacity: int, lines: int, length: int, first_sequence: int):
        self.capacity, self.length = capacity, length
        self.next = first_sequence
        self.open: dict[int, np.ndarray] = {}
        self.none = np.empty((lines + 2, 0), np.int64)

    def _filled(self, rows: np.ndarray, each: int) -> np.ndarray:
        """``rows`` with their sequence and offset, ``each`` pieces to a sequence."""
        n = rows.shape[1]
        at = np.arange(n) // each
        ends = np.cumsum(rows[self.length])
        begins = ends - rows[self.length]
        offset = begins - np.repeat(begins[::each], np.diff(np.append(np.arange(0, n, each), n)))
        numbered = np.vstack([rows, self.next + at, offset])
        self.next += -(-n // each)
        return numbered

    def add(self, rows: np.ndarray) -> np.ndarray:
        out = [self.none]
        kind = self.capacity // rows[self.length]
        order = np.argsort(kind, kind="stable")
        cuts = np.flatnonzero(np.diff(kind[order])) + 1
        for part in np.split(order, cuts):
            if not len(part):
                continue
            k = int(kind[part[0]])
            held = self.open.pop(k, None)
            mine = rows[:, part] if held is None else np.hstack([held, rows[:, part]])
            full = mine.shape[1] // k * k
            if full:
                out.append(self._filled(mine[:, :full], k))
            if full < mine.shape[1]:
                self.open[k] = mine[:, full:].copy()
        return np.hstack(out)

    def close(self) -> np.ndarray:
        out = [self.none]
        for _, rows in sorted(self.open.items(), reverse=True):
            size, n, at = int(rows[self.length, 0]), rows.shape[1], 0
            if (rows[self.length] == size).all() and size & (size - 1) == 0:
                for bit in reversed(range(n.bit_length())):
                    if n >> bit & 1:
                        out.append(self._filled(rows[:, at : at + (1 << bit)], 1 << bit))
                        at += 1 << bit
            else:
                out.append(self._filled(rows, n))
        self.open.clear()
        return np.hstack(out)


def pack_harmonic(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY, least: int = 1,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place (see the module).

    ``tokenizer`` is a byte-level tokenizer file of the ``tokenizers`` library;
    ``end_id`` follows each document's ids.  Null text: the end id alone.
    Null ids stay null; repeated rows are packed each; an empty table gives no
    rows; other columns are not read.  A document of any length is one row's
    work.  ``docs`` must give a task's rows again in the same order when the
    task is repeated (a scan does, a shuffle need not: write it first).
    """
    def run(batches):
        tokens = ByteTokens.load(tokenizer)
        bins = HarmonicBins(capacity, 6, 3, TaskContext.get().partitionId() << TASK_BITS)

        def table(rows: np.ndarray) -> pa.RecordBatch:
            key, known, *rest = rows
            arrays = [pa.array(key, mask=known == 0)] + [pa.array(c) for c in rest]
            return pa.record_batch(arrays, names=_NAMES)

        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                raw, first = tokens.encode_rows(*utf8(part.column(1)))
                ids = np.insert(raw.view(tokens.dtype).astype("<u4"), first[1:], end_id)
                size = np.diff(first) + 1
                length, doc = cut_lengths(size, capacity, least)
                begin = np.cumsum(length) - length
                view = memoryview(ids).cast("B")
                crc = np.fromiter((zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())),
                                  np.int64, len(length))
                known = part.column(0).is_valid().to_numpy(zero_copy_only=False)
                key = part.column(0).fill_null(0).to_numpy()
                start = begin - (np.cumsum(size) - size)[doc]
                full = bins.add(np.vstack([key[doc], known[doc], start, length, crc, size[doc]]))
                if full.shape[1]:
                    yield table(full)
        yield table(bins.close())

    return text_rows(docs, id_col, text_col).mapInArrow(run, FIELDS)


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row on a packing: sequences, ids, padding and pieces.  A sequence whose fill is a power of two is not padded."""
    fills = packed.groupBy("sequence_id").agg({"length": "sum", "*": "count"}).toDF("sequence_id", "fill", "pieces")
    return fills.selectExpr("cast(fill as long) AS fill", "pieces").selectExpr(
        "count(*) AS sequences", "coalesce(sum(fill), 0) AS ids",
        f"coalesce(sum(if((fill & (fill - 1)) = 0, 0, {capacity} - fill)), 0) AS padding", "coalesce(sum(pieces), 0) AS pieces")


def op13_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_harmonic(documents(spark, sf_dir), vocabulary_path(BYTE_TOKENIZER))
