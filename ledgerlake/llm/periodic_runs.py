"""Operator 11: periodic runs of words, by recompression.

A run is a stretch of words with smallest period q, at least two periods and
``least_length`` words long, that no neighbour extends.  For every period p a
grid is laid over the document, as wide as the equal pairs (word, word p
later) that a run of that period has at least: so any run holds a grid place
that equals the word p later.  Such places are candidates; a grammar built by
recompression over the documents that have any answers how far each pair
extends both ways, exactly (see ``recompression``).  A stretch met with several periods
has the smallest of them.

Work is n log n grid places for n words.  All documents of a slice are handled
as arrays; a document is one row's work, however long.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices, text_rows, utf8
from .recompression import Grammar

LEAST_LENGTH = 12
BATCH_BYTES = 8 << 20
# Grid places and candidates held at a time.
GRID_PLACES, HELD_CANDIDATES = 1 << 20, 1 << 20
# Runs as long as this spare the candidates that lie within them.
COVER_LENGTH = 64
FIELDS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

# The bytes between words.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def split_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Code of every word, the distinct words, and each row's first word (one more at the end)."""
    solid = ~_SPACE[buf]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(buf)]
    begins[edges] = solid[edges]
    at = np.flatnonzero(begins)
    before = np.cumsum(solid)[at] - 1 if len(at) else at
    data = buf[solid]
    bounds = np.append(before, len(data)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), words.dictionary, np.searchsorted(at, offsets)


def plant(codes: np.ndarray, first: np.ndarray, keys: list) -> None:
    """Repeat a stretch in the documents that a checksum of the id picks (in place); null ids: none."""
    for row, key in enumerate(keys):
        n = int(first[row + 1] - first[row])
        h = 1 if key is None else zlib.crc32(b"%d" % key)
        if n and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = codes[first[row] : first[row + 1]]
            own[a:] = own[a + np.arange(n - a) % p]


def grid_candidates(codes: np.ndarray, first: np.ndarray, least: int):
    """(place, period) arrays: grid places that equal the word a period later, as do two more beside them."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    n, base = sizes[order], first[:-1][order]
    total = np.cumsum(n)
    period = 1
    while docs := int(np.searchsorted(-n, -max(least, 2 * period), "right")):
        step = max(least - period, period)
        places = int(total[docs - 1]) // step + docs
        width = max(1, min(GRID_PLACES // places, period))
        p = np.arange(period, period + width)
        g = np.maximum(least - p, p)
        own = n[:docs, None]
        count = np.where(own >= np.maximum(least, 2 * p), (own - 1 - p) // g + 1, 0).ravel()
        ends = np.cumsum(count)
        cell = np.repeat(np.arange(len(count)), count)
        doc, which = cell // width, cell % width
        place = base[doc] + (np.arange(len(cell)) - (ends - count)[cell]) * g[which]
        far = p[which]
        met = np.flatnonzero(codes[place] == codes[place + far])
        place, far, doc = place[met], far[met], doc[met]
        if least >= 6 and len(place):  # then a run has three equal pairs in a row around any of its places
            low, high = base[doc], base[doc] + n[doc] - far

            def equal(shift: int) -> np.ndarray:
                there = place + shift
                inside = (there >= low) & (there < high)
                there = np.where(inside, there, place)
                return inside & (codes[there] == codes[there + far])

            before, after = equal(-1), equal(1)
            close = np.flatnonzero(before & after | before & equal(-2) | after & equal(2))
            place, far = place[close], far[close]
        if len(place):
            yield place, far
        period += width


class _Runs:
    """Runs found so far in one slice, and the places they cover."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, least: int):
        self.codes, self.first, self.least = codes, first, least
        self.cover = np.full(len(codes), -1)
        self.found = np.empty((3, 0), np.int64)  # start, end, period; places in the slice

    def fresh(self, place: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Candidates that are not within a known run whose period divides theirs (they would give it again)."""
        run = self.cover[place]
        _, end, period = (line[run] if len(line) else np.ones_like(run) for line in self.found)
        return (run < 0) | (far % period > 0) | (place + far >= end)

    def extend(self, place: np.ndarray, far: np.ndarray) -> None:
        """Extend candidates on a grammar of the documents that have any."""
        doc = np.searchsorted(self.first, place, "right") - 1
        docs = np.unique(doc)
        low, high = self.first[docs], self.first[docs + 1]
        inside = np.zeros(len(self.codes) + 1, np.int64)
        np.add.at(inside, low, 1)
        np.add.at(inside, high, -1)
        inside = np.cumsum(inside[:-1]) > 0
        moved = np.cumsum(inside) - 1
        grammar = Grammar(self.codes[inside])
        x = moved[place]
        forward = np.minimum(grammar.forward(x, x + far), self.first[doc + 1] - place - far)
        backward = np.minimum(grammar.backward(x, x + far), place - self.first[doc])
        start, end = place - backward, place + far + forward
        long = end - start >= np.maximum(self.least, 2 * far)
        found = np.hstack([self.found, np.stack([start[long], end[long], far[long]])])
        found = found[:, np.lexsort((found[2], found[1], found[0]))]
        new = np.ones(found.shape[1], bool)
        new[1:] = (np.diff(found[0]) > 0) | (np.diff(found[1]) > 0)
        self.found = found[:, new]
        self.cover[:] = -1
        size = self.found[1] - self.found[0]
        wide = np.flatnonzero(size >= COVER_LENGTH)
        for run in wide[np.argsort(size[wide], kind="stable")].tolist():
            self.cover[self.found[0, run] : self.found[1, run]] = run


def runs_of(codes: np.ndarray, first: np.ndarray, least: int = LEAST_LENGTH) -> np.ndarray:
    """Start, end and period of every run of all rows, by start, then end."""
    runs, held, n = _Runs(codes, first, least), [], 0
    for place, far in grid_candidates(codes, first, least):
        fresh = runs.fresh(place, far)
        held.append((place[fresh], far[fresh]))
        n += int(fresh.sum())
        if n > HELD_CANDIDATES:
            runs.extend(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        runs.extend(*map(np.concatenate, zip(*held)))
    return runs.found


def periodic_runs(docs: DataFrame, least_length: int = LEAST_LENGTH, planted: bool = False,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every whole text.

    ``runs`` are by start, then period; places are word numbers from 0.
    ``collapsed`` joins by one space the words that lie in no run beyond its
    first period.  ``planted`` first repeats a stretch in some documents (see
    :func:`plant`; null ids: none).  Null and empty texts have no words; null
    ids and repeated rows give a row each; an empty table gives no rows; other
    columns are not read.
    """
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                codes, words, first = split_words(*utf8(part.column(1)))
                if planted:
                    plant(codes, first, part.column(0).to_pylist())
                start, end, period = runs_of(codes, first, least_length)
                order = np.lexsort((period, start))
                start, end, period = start[order], end[order], period[order]
                change = np.zeros(len(codes) + 1, np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, end, -1)
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
                spaced = pa.array([w + b" " for w in words.to_pylist()], pa.binary()).take(pa.array(codes[kept]))
                where = np.frombuffer(spaced.buffers()[1], np.int32)[spaced.offset : spaced.offset + len(spaced) + 1] if len(kept) else np.zeros(1, np.int32)
                cuts = where[np.searchsorted(kept, first)].tolist()
                raw = memoryview(spaced.buffers()[2] or b"")
                texts = [bytes(raw[a : b - 1]) if b > a else b"" for a, b in zip(cuts[:-1], cuts[1:])]
                bounds = np.searchsorted(start, first).astype(np.int32)
                doc = np.searchsorted(first, start, "right") - 1
                structs = pa.StructArray.from_arrays([pa.array(start - first[doc]), pa.array(end - start), pa.array(period)], ["start", "length", "period"])
                yield pa.record_batch([part.column(0), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(bounds), structs),
                                       pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return text_rows(docs, id_col, text_col).mapInArrow(run, FIELDS)


def digests(found: DataFrame) -> DataFrame:
    """The longest run (ties: smallest start, then period) and checksums of :func:`periodic_runs` rows."""
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"
    listed = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    return found.selectExpr("*", f"{longest} AS top").selectExpr(
        "doc_id", "cast(size(runs) AS long) AS n_runs", "-top.start AS start", "top.length AS length", "-top.period AS period",
        "1000 * top.length DIV -top.period AS exponent_milli",
        f"sha2({listed}, 256) AS runs_sha256", "sha2(collapsed, 256) AS collapsed_sha256")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(documents(spark, sf_dir), planted=True))
