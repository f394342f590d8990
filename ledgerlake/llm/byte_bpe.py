"""Operator 6: byte-level BPE encoding and decoding.

The merge queue of one pre-token is a hierarchical bitmap over merge ranks:
each rank has a bucket of positions in a doubly linked list of parts, and
find-first-set over three levels of 64-bit words gives the lowest rank that
waits.  Entries that a neighbouring merge has outdated are skipped when they
surface, so a pre-token of n bytes takes O(n log n) steps however long it is.

Texts are cut only where the pattern always starts a match (a lone space
between two visible characters), the distinct pieces of a batch are encoded
once, and their ids laid out again by Arrow.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, slices, text_rows, utf8
from .segments import PieceEncoder, spaced_words

BYTE_VOCABULARY = "byte_bpe_50k.tiktoken"
BATCH_BYTES = 12 << 20
CACHED_WORDS = 300_000
_loaded: dict[tuple[str, str], "ByteBpe"] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Bucket per rank, found through three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def _mark(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
        self.top |= 1 << (rank >> 12)

    def _unmark(self, rank: int) -> None:
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << ((rank >> 6) & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))

    def _first(self) -> int:
        top = self.top
        if not top:
            return -1
        a = (top & -top).bit_length() - 1
        word = self.mid[a]
        b = (a << 6) | ((word & -word).bit_length() - 1)
        word = self.low[b]
        return (b << 6) | ((word & -word).bit_length() - 1)

    def add(self, rank: int, entry) -> None:
        """Put any entry (a position, an array of positions) into a rank's bucket."""
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [entry]
            self._mark(rank)
        else:
            bucket.append(entry)

    def take(self) -> tuple[int, list] | None:
        """Lowest rank with its whole bucket; None when empty."""
        rank = self._first()
        if rank < 0:
            return None
        self._unmark(rank)
        return rank, self.buckets.pop(rank)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.add(rank, position)
        else:
            heappush(bucket, position)

    def pop(self) -> tuple[int, int] | None:
        """Lowest rank, leftmost position; None when empty."""
        rank = self._first()
        if rank < 0:
            return None
        bucket = self.buckets[rank]
        position = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self._unmark(rank)
        return rank, position


class ByteBpe:
    """Encoder and decoder over ``ranks`` (token bytes -> id, the id being the merge rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values()) + 1)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.binary())
        self.encode_rows = PieceEncoder(spaced_words, self._pieces, 4)
        self.words: dict[bytes, bytes] = {}
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.pairs = self._pairs()

    @staticmethod
    def load(path: str, pattern: str) -> "ByteBpe":
        if (path, pattern) not in _loaded:
            _loaded[path, pattern] = ByteBpe(load_ranks(path), pattern)
        return _loaded[path, pattern]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: lowest rank first, leftmost first among equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [-1] * n  # rank of the pair that begins here
        queue = self.queue
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                waiting[i] = rank
                queue.push(rank, i)
        while (entry := queue.pop()) is not None:
            rank, i = entry
            if waiting[i] != rank:
                continue  # stale: one of the two parts has merged meanwhile
            j = right[i]
            parts[i] += parts[j]
            parts[j], waiting[j] = None, -1
            k = right[i] = right[j]
            waiting[i] = -1
            if k < n:
                left[k] = i
                new = ranks.get(parts[i] + parts[k])
                if new is not None:
                    waiting[i] = new
                    queue.push(new, i)
            h = left[i]
            if h >= 0:
                new = ranks.get(parts[h] + parts[i])
                waiting[h] = -1 if new is None else new
                if new is not None:
                    queue.push(new, h)
        return [ranks[p] for p in parts if p is not None]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every two ids whose bytes join to a token: sorted ``left * size + right``, and the token."""
        ranks, size, keys, made = self.ranks, len(self.tokens), [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    made.append(rank)
        order = np.argsort(keys)
        return np.array(keys, np.int64)[order], np.array(made, np.int64)[order]

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; -1 where they don't join."""
        keys, made = self.pairs
        wanted = left * len(self.tokens) + right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, made[at], -1)

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids (raw, 32-bit) of many pre-tokens in one queue.

        Parts of different pre-tokens never join, so each sees its own pairs
        in rank order, and one rank's bucket is merged as arrays.  A run of
        overlapping pairs merges every second one, as leftmost-first does.
        If a merge ever makes a pair of a lower rank than its own (never with
        ranks that come from training), that pre-token is done alone.
        """
        buf = np.frombuffer(b"".join(words), np.uint8)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        n, queue = len(buf), RankQueue(len(self.tokens))
        ids = self.byte_ids[buf]
        right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
        right[ends - 1] = -1
        left[ends - sizes] = -1
        waiting = np.full(n, -1)
        inner = np.flatnonzero(right >= 0)
        waiting[inner] = self._joined(ids[inner], ids[inner + 1])
        alive = np.ones(n, bool)
        alone: list[int] = []
        self._push(queue, inner, waiting)
        while (entry := queue.take()) is not None:
            rank, bucket = entry
            at = np.unique(np.concatenate(bucket)) if len(bucket) > 1 else bucket[0]
            at = at[waiting[at] == rank]  # the others are stale
            if not len(at):
                continue
            follows = np.zeros(len(at), bool)
            follows[1:] = right[at[:-1]] == at[1:]
            if follows.any():
                place = np.arange(len(at))
                run = np.maximum.accumulate(np.where(follows, 0, place))
                at = at[(place - run) % 2 == 0]
            gone = right[at]
            ids[at] = rank
            alive[gone] = False
            waiting[gone] = -1
            beyond = right[gone]
            right[at] = beyond
            waiting[at] = -1
            inside = beyond >= 0
            left[beyond[inside]] = at[inside]
            before = left[at]
            touched = np.concatenate([at[inside], before[before >= 0]])
            if len(touched) > 1:
                touched = np.unique(touched)
            new = self._joined(ids[touched], ids[right[touched]])
            waiting[touched] = new
            if (early := (new >= 0) & (new < rank)).any():
                alone += np.searchsorted(ends, touched[early], "right").tolist()
            self._push(queue, touched, waiting)
        raw = ids[alive].astype("<u4").tobytes()
        cuts = (np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] * 4).tolist()
        out = [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i in set(alone):
            out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out

    @staticmethod
    def _push(queue: RankQueue, at: np.ndarray, waiting: np.ndarray) -> None:
        ranks = waiting[at]
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist()]
        for rank, a, b in zip(ranks[begins].tolist(), begins, [*begins[1:], len(at)]):
            queue.add(rank, at[a:b])

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        words = self.words
        if len(words) > CACHED_WORDS:
            words.clear()
        split = [[w.encode() for w in self.pattern.findall(p.decode("utf-8"))] for p in pieces]
        new = list({w for ws in split for w in ws if w not in words})
        fresh = {w: np.array([self.ranks[w]], "<u4").tobytes() for w in new if w in self.ranks}
        rest = [w for w in new if w not in fresh]
        if rest:
            fresh.update(zip(rest, self.merge_many(rest)))
        out = [b"".join([words.get(w) or fresh[w] for w in ws]) for ws in split]
        words.update((w, ids) for w, ids in fresh.items() if len(w) <= 64)
        return out

    def encode(self, text: str) -> list[int]:
        raw, _ = self.encode_rows(*utf8(pa.array([text])))
        return raw.view("<u4").tolist()

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and where each id's bytes begin (one more at the end)."""
        laid = self.tokens.take(pa.array(ids))
        where = np.frombuffer(laid.buffers()[1], np.int32)[laid.offset : laid.offset + len(laid) + 1]
        data = laid.buffers()[2]
        return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), where


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded bytes of every text: (doc_id, ids binary, decoded binary).

    ``ids`` are little-endian unsigned 32-bit.  Null text: encoded as empty
    (no ids, no bytes).  Null ids, repeated rows and ties: a row each, in any
    order.  Empty table: no rows.  Other columns are not read.
    """

    def run(batches):
        bpe = ByteBpe.load(path, pattern)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                buf, offsets = utf8(part.column(1))
                raw, first = bpe.encode_rows(buf, offsets)
                decoded, where = bpe.decode(raw.view("<u4"))
                cut = where[first] if len(raw) else np.zeros(len(first), np.int32)
                yield pa.record_batch([
                    part.column(0),
                    pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((first * 4).astype(np.int32)), pa.py_buffer(raw)]),
                    pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(decoded)]),
                ], names=["doc_id", "ids", "decoded"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of :func:`encode_decode` rows."""
    return encoded.selectExpr("doc_id", "cast(octet_length(ids) / 4 as long) AS n_tokens",
                              "sha2(ids, 256) AS ids_sha256", "sha2(decoded, 256) AS decoded_sha256")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(documents(spark, sf_dir), public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.PATTERN))
