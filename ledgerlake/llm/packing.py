"""Operator 4: best-fit packing with a swap-based local search.

Texts become ids, ids become pieces of at most a sequence's length (only
longer documents are cut), and pieces are packed in groups of bounded size, a
task each.  A group starts from best fit by falling length; then the emptiest
underfull bin gives its pieces away by moves, one-for-one and two-for-one
exchanges with other underfull bins, every step raising the sum of squared
fills, until it is empty or nothing helps.  What lies in the emptiest bins is
pooled over all groups and packed again, so the loss does not grow with the
number of groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, text_rows, utf8, written
from .word_tokens import WordTokens, vocabulary_path

CAPACITY = 4096
END_ID = 1
GROUP_PIECES = 8192
# The search gives up on a group after this many givers in a row that could not be emptied.
PATIENCE = 64
# Of a group's bins, one in so many (the emptiest) is pooled for the next round; there are at most so many rounds.
POOLED_SHARE, ROUNDS = 16, 4
BATCH_BYTES = 16 << 20


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document (null text: the end id alone)."""
    def run(batches):
        tokens = WordTokens.load(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                raw, first = tokens.encode_rows(*utf8(part.column(1)))
                ids = raw.view(tokens.dtype)
                rows = []
                for i, key in enumerate(part.column(0).to_pylist()):
                    own = np.append(ids[first[i] : first[i + 1]], end_id).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), capacity)):
                        cut = own[start : start + capacity]
                        rows.append((key, piece, start, len(cut), zlib.crc32(cut.tobytes())))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                          names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit by falling length: each piece goes where least room is left over."""
    bins: list[list[int]] = []
    open_: dict[int, list[int]] = {}  # bins by room left
    rooms = 0  # bit r is set while a bin with room r is open
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = open_[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            open_.setdefault(left, []).append(b)
            rooms |= 1 << left
    return bins


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins by moves and exchanges that raise the sum of squared fills.

    An exchange takes pieces of total size s from the emptiest bin for a piece
    of size t < s of a bin with room for the difference; it raises the sum of
    squares whenever the receiving bin stays fuller than the giving one was.
    """
    fill = np.array([int(lengths[b].sum()) for b in bins], np.int64)
    fewest = -(-int(lengths.sum()) // capacity)
    count, tried = len(bins), set()
    under = [b for b in range(len(bins)) if fill[b] < capacity]
    while count > fewest:
        givers = [b for b in under if b not in tried and bins[b]]
        if not givers or len(tried) >= PATIENCE:
            break
        giver = min(givers, key=lambda b: fill[b])
        tried.add(giver)
        moved = True
        while moved and bins[giver]:
            moved = False
            others = np.array([b for b in under if b != giver and bins[b] and fill[b] < capacity], np.int64)
            if not len(others):
                break
            room = capacity - fill[others]
            own = sorted(bins[giver], key=lambda i: -lengths[i])
            for i in own:  # move
                fits = np.flatnonzero(room >= lengths[i])
                if len(fits):
                    to = int(others[fits[np.argmin(room[fits])]])
                    bins[giver].remove(i)
                    bins[to].append(i)
                    fill[giver] -= lengths[i]
                    fill[to] += lengths[i]
                    moved = True
                    break
            if moved:
                continue
            items = np.concatenate([bins[b] for b in others])
            where = np.repeat(np.arange(len(others)), [len(bins[b]) for b in others])
            sizes = lengths[items]
            best = (0, None, None)
            given = [(i,) for i in own] + [(a, b) for k, a in enumerate(own) for b in own[k + 1 :]]
            for give in given:  # one for one, two for one
                gain = int(sum(lengths[i] for i in give)) - sizes
                gain = np.where((gain > 0) & (gain <= room[where]) & (fill[others][where] + gain > fill[giver]), gain, 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (int(gain[k]), give, k)
            if best[1] is not None:
                gain, give, k = best
                to, back = int(others[where[k]]), int(items[k])
                bins[giver] = [i for i in bins[giver] if i not in give] + [back]
                bins[to] = [i for i in bins[to] if i != back] + list(give)
                fill[giver] -= gain
                fill[to] += gain
                moved = True
        if not bins[giver]:
            count -= 1
            tried.clear()
    return [b for b in bins if b]


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each piece, its place there, and whether the bin is one of the emptiest underfull ones."""
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    fills = sorted((int(lengths[b].sum()), k) for k, b in enumerate(bins))
    pooled = {k for fill, k in fills[: max(1, len(bins) // POOLED_SHARE)] if fill < capacity}
    number, offset, poor = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), bool)
    for b, items in enumerate(bins):
        items = np.array(items)
        number[items] = b
        offset[items] = np.concatenate([[0], np.cumsum(lengths[items])[:-1]])
        poor[items] = b in pooled
    return number, offset, poor


def _packer(number: int, last: bool, capacity: int):
    """Packs one group of a round; its sequences are numbered by round, group and bin."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "start", "ids_crc32"], ignore_index=True)
        b, offset, poor = pack_group(rows["length"].to_numpy(np.int64), capacity)
        named = (number << 52) | (int(key[0]) << 20) | b
        return rows.drop(columns="g").assign(sequence_id=named, offset=offset, full=last | ~poor)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``pieces`` must be a written table.

    Rounds: each packs groups of about ``group_pieces`` pieces side by side and
    keeps all but the emptiest of their bins; what those hold is pooled for
    the next round.  The last round keeps all.  Pieces with equal columns are packed one by one;
    an empty table gives no rows.
    """
    schema = pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, full boolean"
    done, rest, number = [], schema, 0
    while True:
        n = rest.count()
        groups = max(1, -(-n // group_pieces))
        last = groups == 1 or number == ROUNDS - 1

        spread = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", F.lit(number)), F.lit(groups))
        packed = written(rest.withColumn("g", spread).groupBy("g").applyInPandas(_packer(number, last, capacity), fields), "packed")
        done.append(packed.where("full"))
        rest, number = packed.where("not full").select(*schema.columns), number + 1
        if last:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out.drop("full")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence and place.

    Null ids are kept as null, repeated rows are packed each; other columns
    are not read.
    """
    return pack(written(pieces_of(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces"), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary_path())
