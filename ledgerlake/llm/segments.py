"""Encoding whole texts through the pieces they share.

A tokenizer that never lets one token depend on what stands beyond a known
boundary may encode the pieces between boundaries one by one.  Arrow finds the
distinct pieces of a batch; only those a worker has not met go to the
tokenizer, and Arrow's ``take`` lays the ids out again in text order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

CACHE_PIECES = 700_000
CACHE_PIECE_BYTES = 64


class PieceEncoder:
    """``cut(buf, offsets) -> (buf, starts mask)``; ``encode(pieces) -> ids as bytes``."""

    def __init__(self, cut: Callable, encode: Callable, width: int):
        self.cut, self.encode, self.width = cut, encode, width
        self.seen: dict[bytes, bytes] = {}

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        out = [self.seen.get(p) for p in pieces]
        gaps = [i for i, x in enumerate(out) if x is None]
        if gaps:
            if len(self.seen) > CACHE_PIECES:
                self.seen.clear()
            for i, ids in zip(gaps, self.encode([pieces[i] for i in gaps])):
                out[i] = ids
                if len(pieces[i]) <= CACHE_PIECE_BYTES:
                    self.seen[pieces[i]] = ids
        return out

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw id bytes of all rows, and each row's first id (one more at the end)."""
        n = len(buf)
        if n == 0:
            return np.empty(0, np.uint8), np.zeros(len(offsets), np.int64)
        buf, starts = self.cut(buf, offsets)
        starts[offsets[:-1][offsets[:-1] < n]] = True
        begin = np.flatnonzero(starts)
        bounds = np.append(begin, n).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(buf)])
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        ids = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))[codes] // self.width
        ends = np.concatenate([[0], np.cumsum(sizes)])
        laid = pa.array(ids, pa.binary()).take(coded.indices)
        where = np.frombuffer(laid.buffers()[1], np.int32)[laid.offset : laid.offset + len(laid) + 1]
        data = laid.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[where[0] : where[-1]] if data is not None else np.empty(0, np.uint8)
        return raw, ends[np.searchsorted(begin, offsets)]


# Classes of bytes for the word tokenizer's boundaries.
_OTHER, _SPACE, _LETTER, _DIGIT, _QUOTE, _MARK = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _QUOTE
# Certain boundaries between two neighbouring ASCII classes.
_CUT = np.zeros(64, bool)
for _a in range(6):
    _CUT[_a * 8 + _SPACE] = True
for _a, _b in ((_LETTER, _DIGIT), (_LETTER, _QUOTE), (_LETTER, _MARK), (_DIGIT, _LETTER), (_DIGIT, _DIGIT),
               (_DIGIT, _QUOTE), (_DIGIT, _MARK), (_MARK, _LETTER), (_MARK, _DIGIT)):
    _CUT[_a * 8 + _b] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_pieces(specials: list[bytes]) -> Callable:
    """Boundaries of the lower-casing word tokenizer.

    A row that holds one of the tokenizer's ``specials`` literally stays one
    piece, as written.
    """

    def cut(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _CLASS[buf]
        starts = np.empty(len(buf), bool)
        starts[0] = True
        starts[1:] = _CUT[(kind[:-1] << 3) | kind[1:]]
        lowered = _LOWER[buf]
        whole = buf.tobytes()
        for special in specials:
            at = whole.find(special)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                lo, hi = offsets[row], offsets[row + 1]
                starts[lo:hi] = False
                lowered[lo:hi] = buf[lo:hi]
                at = whole.find(special, hi)
        return lowered, starts

    return cut


_SAFE_NEXT = np.zeros(256, bool)
_SAFE_NEXT[0x21:0x7F] = _SAFE_NEXT[0xC3:0xE0] = True
_SAFE_ASCII = np.zeros(256, bool)
_SAFE_ASCII[0x21:0x7F] = True


def spaced_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries before a lone space between two characters that are no white space.

    The byte-level pattern always starts a match there, and no match crosses.
    """
    n = len(buf)
    starts = np.zeros(n, bool)
    at = np.flatnonzero(buf == 32)
    at = at[(at > 0) & (at < n - 1)]
    before, two = buf[at - 1], buf[np.maximum(at - 2, 0)]
    latin = (before >= 0x80) & (before < 0xC0) & (two >= 0xC3) & (two < 0xE0)
    starts[at[_SAFE_NEXT[buf[at + 1]] & (_SAFE_ASCII[before] | latin)]] = True
    return buf, starts
