"""Operator 10: SimHash near-duplicates by anchor-point covering.

The anchors are the words of a covering code of length 64: the direct sum of
two perfect Golay codes of length 23 (covering radius 3 each) and six
repetition codes of length 3 (radius 1 each).  Every fingerprint has a home
anchor, the word that decoding each part gives, within the radius in every
part.  A fingerprint at distance t or less from another lies, over all parts
together, at most t beyond the radius from that one's home.  So each distinct
fingerprint is replicated to every anchor within covering radius plus
threshold, and compared with those at home there; a pair meets at the home of
the smaller one, once, and none is missed.

Copies share a fingerprint and are one row in the search, however many; links
between distinct fingerprints are found by a shuffled join on the anchor.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, documents, ship, slices, text_rows, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BATCH_BYTES = 4 << 20

# The binary Golay code's length, radius and generator polynomial
# x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, and the layout of a fingerprint's bits.
GOLAY_BITS, GOLAY_RADIUS, GOLAY_POLYNOMIAL = 23, 3, 0b101011100011
GOLAY_SHIFTS = (0, 23)
TRIPLE_SHIFTS = (46, 49, 52, 55, 58, 61)

# 8 bits -> 8 lanes of 8 bits, to count bits of many hashes by plain sums.
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row, bits set in over half of its hashes; ``first`` has each row's first hash and the end."""
    rows = len(first) - 1
    counts = np.diff(first)
    out = np.zeros(rows, np.uint64)
    full = np.flatnonzero(counts > 0)
    if not len(full):
        return out
    # Lanes hold up to 255: sums of at most 255 hashes, then summed again.
    begins = [np.arange(first[r], first[r + 1], 255) for r in full.tolist()]
    per_row = np.fromiter(map(len, begins), np.int64, len(begins))
    at = np.concatenate(begins)
    row_at = np.concatenate([[0], np.cumsum(per_row)[:-1]])
    octets = hashes.view(np.uint8).reshape(-1, 8)
    half = counts[full]
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[octets[:, byte]], at)
        ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), row_at, axis=0)
        bits = (2 * ones > half[:, None]).astype(np.uint64)
        out[full] |= (bits << np.arange(8, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(8 * byte)
    return out


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every run of ``words`` words (fewer: of all of them), repeats included."""
    tokens = text.lower().split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    ends, at = [], -1
    for token in tokens:
        at += len(token) + 1
        ends.append(at)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [digest(joined, SEED)]
    begins = [0, *[e + 1 for e in ends]]
    return [digest(joined[a:b], SEED) for a, b in zip(begins, ends[words - 1 :])]


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp): 64-bit SimHash of every whole text (``mark`` is a hash of the text); no word (or null text): zero."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                hashes, sizes = [], [0]
                for text in part.column(1).cast(pa.binary()):
                    hashes += shingle_hashes(text.as_py() or b"", words)
                    sizes.append(len(hashes))
                fp = bit_majority(np.array(hashes, np.uint64), np.array(sizes))
                yield pa.record_batch([part.column(0), part.column(2), pa.array(fp.view(np.int64))], names=["doc_id", "mark", "fp"])

    rows = text_rows(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Golay syndrome: remainder of 23-bit words by the generator polynomial."""
    out = words.astype(np.int64).copy()
    for bit in range(GOLAY_BITS - 1, 10, -1):
        out ^= np.where(out >> bit & 1, GOLAY_POLYNOMIAL << (bit - 11), 0)
    return out


@lru_cache(maxsize=2)
def covering_tables(threshold: int) -> tuple[np.ndarray, dict[int, list[list[np.ndarray]]]]:
    """Golay: the error that leads home, per syndrome; and per excess 1..threshold and
    syndrome, the errors that lead to a code word that far beyond the radius."""
    unit = [int(_remainder(np.array([1 << b]))[0]) for b in range(GOLAY_BITS)]
    home = np.zeros(1 << 11, np.int64)
    beyond = {e: [[] for _ in range(1 << 11)] for e in range(1, threshold + 1)}
    for weight in range(GOLAY_RADIUS + threshold + 1):
        for places in combinations(range(GOLAY_BITS), weight):
            syndrome, error = 0, 0
            for b in places:
                syndrome ^= unit[b]
                error |= 1 << b
            if weight <= GOLAY_RADIUS:
                home[syndrome] = error
            else:
                beyond[weight - GOLAY_RADIUS][syndrome].append(error)
    return home, {e: [np.array(x, np.int64) for x in lists] for e, lists in beyond.items()}


def home_anchors(fp: np.ndarray) -> np.ndarray:
    """The anchor each fingerprint decodes to, part by part."""
    home, _ = covering_tables(0)
    fp = fp.astype(np.uint64)
    out = fp.copy()
    for shift in GOLAY_SHIFTS:
        part = (fp >> np.uint64(shift)).astype(np.int64) & ((1 << GOLAY_BITS) - 1)
        out ^= home[_remainder(part)].astype(np.uint64) << np.uint64(shift)
    for shift in TRIPLE_SHIFTS:
        ones = np.bitwise_count((fp >> np.uint64(shift)) & np.uint64(7))
        word = np.where(ones >= 2, np.uint64(7), np.uint64(0))
        out = (out & ~(np.uint64(7) << np.uint64(shift))) | (word << np.uint64(shift))
    return out


def syndromes(fp: np.ndarray) -> list[list[int]]:
    """Golay syndromes of every fingerprint, a list per part."""
    parts = [(fp >> np.uint64(shift)).astype(np.int64) & ((1 << GOLAY_BITS) - 1) for shift in GOLAY_SHIFTS]
    return [_remainder(p).tolist() for p in parts]


def near_anchors(fp: int, home: int, syndrome: tuple[int, ...], threshold: int) -> np.ndarray:
    """Every anchor at most ``threshold`` beyond the radius from ``fp``, its home included."""
    _, beyond = covering_tables(threshold)
    parts: list[list[np.ndarray]] = []  # per part: by excess, the changes to the home anchor
    for shift, syn in zip(GOLAY_SHIFTS, syndrome):
        own = ((fp ^ home) >> shift) & ((1 << GOLAY_BITS) - 1)
        parts.append([(beyond[e][syn] ^ own) << shift for e in range(1, threshold + 1)])
    for shift in TRIPLE_SHIFTS:
        off = ((fp ^ home) >> shift & 7).bit_count()  # 0 or 1 from home, so 3 or 2 from the other word
        change = np.array([np.uint64(7 << shift)], np.uint64).view(np.int64)
        parts.append([change if 3 - off - 1 == e else np.empty(0, np.int64) for e in range(1, threshold + 1)])
    reached = [np.zeros(1, np.int64), *[np.empty(0, np.int64) for _ in range(threshold)]]
    for part in parts:
        grown = [list([x]) for x in reached]
        for spent in range(threshold):
            if len(reached[spent]):
                for e in range(1, threshold - spent + 1):
                    if len(part[e - 1]):
                        grown[spent + e].append((reached[spent][:, None] ^ part[e - 1][None, :]).ravel())
        reached = [np.concatenate(x) if len(x) > 1 else x[0] for x in grown]
    return np.concatenate(reached) ^ np.array([home], np.uint64).view(np.int64)


def near_links(prints: DataFrame, threshold: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``prints(fp)`` at ``threshold`` or fewer differing bits."""
    ship(prints.sparkSession)

    def homes(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            yield pa.record_batch([pa.array(home_anchors(fp).view(np.int64)), batch.column(0)], names=["anchor", "a"])

    def replicas(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            home = home_anchors(fp.view(np.uint64))
            for lo in range(0, len(fp), 2000):
                own = fp[lo : lo + 2000].view(np.uint64)
                each = zip(own.tolist(), home[lo : lo + 2000].tolist(), zip(*syndromes(own)))
                near = [near_anchors(f, h, s, threshold) for f, h, s in each]
                many = np.fromiter(map(len, near), np.int64, len(near))
                yield pa.record_batch([pa.array(np.concatenate(near)), pa.array(np.repeat(fp[lo : lo + 2000], many))], names=["anchor", "b"])

    at_home = prints.mapInArrow(homes, "anchor long, a long")
    there = prints.mapInArrow(replicas, "anchor long, b long")
    close = F.expr(f"a < b AND bit_count(a ^ b) <= {int(threshold)}")
    return at_home.hint("merge").join(there, (at_home["anchor"] == there["anchor"]) & close).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, threshold: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, mark, fp long, root, component_id).

    Documents whose fingerprints differ in ``threshold`` or fewer bits are
    linked; ``component_id`` is the smallest doc_id reachable.  Null text and
    texts without a word have fingerprint zero and are linked like any other.
    Repeated rows are a row each; a null id is never the smallest (a component
    of null ids only has a null component_id; ``root``, its smallest
    fingerprint, still names it).  Empty table: no rows.  Other columns are
    not read.
    """
    rows = written(fingerprints(docs, words, id_col, text_col), "simhash")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    nodes = connected_components(near_links(prints.select("fp"), threshold), "simhash")
    named = prints.join(nodes, prints["fp"] == nodes["node"], "left")
    named = named.select("fp", "least", F.coalesce("component", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select("doc_id", "mark", "fp", "root", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
