"""Operator 9: repeated byte strings by bucket-pointer refinement.

Suffixes are put in buckets by a q-gram, and buckets are refined by the bucket
identifiers of later offsets: the bucket of depth 2h at a place is the pair of
the depth-h buckets at the place and h further on, and refined identifiers
serve the next refinement.  Identifiers come from the content (hashes of
hashes), so the same string has the same bucket in every task, no global
renumbering is needed, and Spark's shuffle on the identifier is the sort.

Only suffixes at anchors are refined, not every place.  An anchor is the
smallest q-gram identifier of a span of consecutive places; every string of
``length`` bytes holds such a span, equal strings choose equal anchors, and so
two equal strings always meet in an anchor's bucket.  The levels:

1. q-gram buckets of the anchors; those with a single suffix are finished.
2. refined by the bucket of everything that a string through the anchor can
   reach to either side.  Suffixes that share that bucket repeat as a whole.
3. where a q-gram bucket fell into several, its strings of ``length`` bytes
   through the anchor are bucketed one by one, one suffix speaking for each
   bucket of level 2.  A task takes whole buckets of at most ``HOT_CONTEXTS``
   suffixes.  Larger ones are refined again by depth, over all tasks.  Their
   strings, taken by the distance to the anchor, fall into ranges of
   ``CORE_STARTS`` neighbouring starts.  What all strings of a range have in
   common is its core, all that they cover its extent.  A core met once: none
   of its strings repeats.  An extent met twice: all do.  Where a core is met
   with several extents, one range speaks for each extent, is cut into
   ``FINER_PARTS`` and judged again; what then is still open (the parts that
   hold the very edge of a passage) is counted string by string.

Work is linear in the anchors: a bucket is counted before the shuffle, and no
pairs are formed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, slices, text_rows, utf8, written

LENGTH = 200
QGRAM = 32
# Text that a task takes at a time; its arrays are some 70 times that.
BATCH_BYTES = 1 << 19
# Contexts whose strings a task holds at a time, as far as buckets allow (a bucket stays whole).
HELD_CONTEXTS = 1000
# Contexts of one q-gram bucket that a task takes together; larger buckets are refined over all tasks, with equal results.
HOT_CONTEXTS = 8000
# Neighbouring starts that share a core.
CORE_STARTS = 24
# Finer ranges that a range still open is cut into, before its strings are taken one by one.
FINER_PARTS = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_IDS = np.array([xxhash.xxh64_intdigest(bytes([b]), 9) for b in range(256)], np.uint64)


def bucket_ids(buf: np.ndarray, depth: int) -> np.ndarray:
    """Identifier of the ``depth`` bytes at every place, by doubling (the last step overlaps)."""
    ids, reach = _BYTE_IDS[buf], 1
    with np.errstate(over="ignore"):
        while reach < depth:
            step = min(reach, depth - reach)
            if len(ids) <= step:
                return np.empty(0, np.uint64)
            ids = (ids[:-step] ^ (ids[:-step] >> np.uint64(29))) * _ODD + ids[step:]
            reach += step
        ids = ids ^ (ids >> np.uint64(32))
        return ids * _ODD


def _sliding(values: np.ndarray, span: int, ufunc) -> np.ndarray:
    """``ufunc`` (minimum or maximum) over every run of ``span`` values."""
    n = len(values)
    blocks = -(-n // span)
    fill = np.full(blocks * span - n, values[-1])
    table = np.concatenate([values, fill]).reshape(blocks, span)
    ahead = ufunc.accumulate(table, axis=1).ravel()
    back = ufunc.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return ufunc(back[: n - span + 1], ahead[span - 1 : n])


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all anchors in ``buf`` and their q-gram identifiers (rows end at ``offsets``)."""
    span = length - q + 1
    if len(buf) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ids = bucket_ids(buf, q)
    least = _sliding(ids, span, np.minimum)
    inside = np.zeros(len(least), bool)  # places where a string of ``length`` bytes begins
    starts, ends = offsets[:-1], offsets[1:] - length + 1
    marks = np.zeros(len(least) + 1, np.int32)
    whole = ends > starts
    np.add.at(marks, starts[whole], 1)
    np.add.at(marks, np.minimum(ends[whole], len(least)), -1)
    inside = np.cumsum(marks[:-1]) > 0
    least = np.where(inside, least, 0)
    # A place is an anchor if it is the least of any span that holds it.
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    best = _sliding(padded, span, np.maximum)
    at = np.flatnonzero(best[: len(ids)] == ids)
    return at, ids[at]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _anchor_rows(length: int, q: int, contexts: bool):
    """Level 1: (bucket) or (bucket, context, key, hash, place) of every anchor."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                buf, offsets = utf8(part.column(1))
                at, ids = anchors(buf, offsets, length, q)
                if not len(at):
                    continue
                if not contexts:
                    yield pa.record_batch([_signed(ids)], names=["bucket"])
                    continue
                row = np.searchsorted(offsets, at, "right") - 1
                begin, end = offsets[row], offsets[row + 1]
                lo, hi = np.maximum(begin, at + q - length), np.minimum(end, at + length)
                view, digest = memoryview(buf.tobytes()), xxhash.xxh3_64_intdigest
                # The place within the context is part of it: the same bytes further left are another one.
                context = np.fromiter((digest(view[a:b], seed=s) for a, b, s in zip(lo.tolist(), hi.tolist(), (at - lo).tolist())), np.uint64, len(at))
                key, mark = part.column(0).take(pa.array(row)), part.column(2).take(pa.array(row))
                yield pa.record_batch([_signed(ids), _signed(context), key, mark, pa.array(at - begin)], names=["bucket", "context", "doc_id", "mark", "place"])

    return run


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``runs`` with those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(runs):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def spans_of(places: list[int], runs: list[tuple[int, int]], size: int, length: int, q: int) -> list[tuple[int, int]]:
    """Maximal removed runs: the contexts of ``places`` and the ``runs`` together."""
    reach = [(max(0, p + q - length), min(size, p + length)) for p in places]
    return _merged([r for r in reach if r[1] - r[0] >= length] + runs)


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                   ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_sha256", pa.string())])
_PART = pa.struct([("ctx", pa.int64()), ("bucket", pa.int64()), ("hot", pa.bool_()), ("begin", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])
_OPEN = pa.schema([("mark", pa.int64()), ("text", pa.string()), ("shared", pa.list_(pa.int64())), ("parts", pa.list_(_PART)), *_KEPT])


def _kept(key, text: bytes, places: list[int], runs: list[tuple[int, int]], length: int, q: int) -> tuple:
    spans = spans_of(places, runs, len(text), length, q)
    at, digest = 0, hashlib.sha256()
    for lo, hi in [*spans, (len(text), len(text))]:
        digest.update(text[at:lo])
        at = hi
    return key, len(text), sum(b - a for a, b in spans), len(spans), [list(s) for s in spans], digest.hexdigest()


def _open_rows(length: int, q: int):
    """Per document the contexts of its open anchors; one without any is finished here and leaves its result.

    Contexts are numbered by task; only rows of the written table are read, so
    a repeated task's numbers are met once.
    """
    def run(batches):
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                rows, held = [], 0
                texts = part.column(2).cast(pa.binary())
                for i, (key, mark) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                    text, shared, open_ = texts[i].as_py(), part.column(3)[i].as_py() or [], part.column(4)[i].as_py() or []
                    if not open_:
                        rows.append((mark, None, None, None, *_kept(key, text, shared, [], length, q)))
                    else:
                        parts = []
                        for o in open_:
                            lo = max(0, o["place"] + q - length)
                            parts.append({"ctx": number, "bucket": o["bucket"], "hot": o["hot"], "begin": lo, "at": o["place"] - lo,
                                          "bytes": text[lo : o["place"] + length]})
                            number += 1
                        held += len(parts)
                        rows.append((mark, text.decode("utf-8", "surrogatepass"), shared, parts, key, None, None, None, None, None))
                    if len(rows) == 200 or held > HELD_CONTEXTS:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _OPEN)], schema=_OPEN)
                        rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _OPEN)], schema=_OPEN)

    return run


_RUNS = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


def repeated_in_buckets(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Runs of each document that repeat within whole buckets, given as rows (bucket, doc_id, mark, begin, at, bytes).

    Equal strings through the anchors lie at the same distance from them, so a
    string's bucket is the anchor's bucket, that distance and the string's
    own identifier.
    """
    bucket, begin, at = (rows.column(i).to_numpy() for i in (0, 3, 4))
    buf, offsets = utf8(rows.column(5))
    many = np.maximum(0, np.minimum(at, np.diff(offsets) - length) + 1)
    row = np.repeat(np.arange(len(many)), many)
    place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    ids = bucket_ids(buf, length)[offsets[row] + place]
    number = np.concatenate([[0], np.cumsum(bucket[1:] != bucket[:-1])]) if len(bucket) else bucket
    where = number[row] * (length + 1) + at[row] - place
    order = np.lexsort((ids, where))
    same = (ids[order[1:]] == ids[order[:-1]]) & (where[order[1:]] == where[order[:-1]])
    again = np.zeros(len(row), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    row, place = row[again], place[again]
    starts = np.ones(len(row), bool)
    starts[1:] = (row[1:] != row[:-1]) | (np.diff(place) > length)
    first = np.flatnonzero(starts)
    last = np.append(first[1:], len(row))[: len(first)] - 1
    own = pa.array(row[first])
    return pa.record_batch([rows.column(1).take(own), rows.column(2).take(own), pa.array(begin[row[first]] + place[first]),
                            pa.array(begin[row[last]] + place[last] + length)], names=["doc_id", "mark", "lo", "hi"])


def bucket_groups(bucket: np.ndarray, most: int):
    """(begin, end) of runs of whole buckets in sorted ``bucket``: ``most`` rows at the most, or a single bucket."""
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
    at = 0
    while at < len(bucket):
        k = max(int(np.searchsorted(ends, at + most, "right")) - 1, int(np.searchsorted(ends, at, "right")))
        yield at, int(ends[k])
        at = int(ends[k])


def _bucket_rows(length: int):
    """Level 3: rows (bucket, doc_id, mark, begin, at, bytes) sorted by bucket -> repeated runs, whole buckets at a time."""
    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            bucket = held.column(0).to_numpy()
            cut = int(np.searchsorted(bucket, bucket[-1]))
            for begin, end in bucket_groups(bucket[:cut], HELD_CONTEXTS):
                yield repeated_in_buckets(held.slice(begin, end - begin), length)
            held = held.slice(cut)
        if held is not None:
            yield repeated_in_buckets(held, length)

    return run


_CORES = pa.schema([("core", pa.int64()), ("extent", pa.int64()), ("ctx", pa.int64()), ("near", pa.int32()), ("far", pa.int32())])
_FINER = pa.schema([*_CORES, ("alone", pa.bool_())])
_STRINGS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ctx", pa.int64()), ("near", pa.int32()), ("alone", pa.bool_())])
_BATCH_ROWS = 20_000


def _batches_of(rows, schema: pa.Schema):
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def core_ranges(context: bytes, at: int, length: int, starts: int, nearest: int = 0, farthest: int | None = None):
    """(core, extent, nearest, farthest distance from the anchor) of each range of a context's strings.

    Only strings between the distances ``nearest`` and ``farthest`` are taken, if given.

    Ranges are cut at multiples of ``starts`` of the distance, so equal strings
    are in equal ranges; a range cut short by the document's edge has the core
    of the whole one, and an extent of its own.
    """
    first, last = max(nearest, at + length - len(context)), at if farthest is None else min(at, farthest)
    for number in range(first // starts, last // starts + 1):
        begin, end = number * starts, number * starts + starts - 1
        near, far = max(first, begin), min(last, end)
        yield context[at - begin : at - end + length], context[at - far : at - near + length], near, far


def _core_rows(length: int, starts: int):
    """Hot buckets: contexts (ctx, at, bytes) -> identifiers of the core and extent of every range."""
    digest = xxhash.xxh3_64_intdigest

    def rows(batch):
        for ctx, at, context in zip(*[c.to_pylist() for c in batch.columns]):
            for core, extent, near, far in core_ranges(context, at, length, starts):
                yield (digest(core, seed=near // starts) - 2**63, digest(extent, seed=near * (length + 1) + far) - 2**63, ctx, near, far)

    def run(batches):
        for batch in batches:
            yield from _batches_of(rows(batch), _CORES)

    return run


def _string_rows(length: int):
    """Hot buckets: (ctx, at, bytes, ranges) -> two identifiers of each string of the ranges."""
    def rows(batch):
        for ctx, at, context, ranges in zip(*[c.to_pylist() for c in batch.columns]):
            for r in ranges:
                for far in range(r["near"], r["far"] + 1):
                    h = xxhash.xxh3_128_intdigest(context[at - far : at - far + length], seed=far)
                    yield (h >> 64) - 2**63, (h & (2**64 - 1)) - 2**63, ctx, far, r["alone"]

    def run(batches):
        for batch in batches:
            yield from _batches_of(rows(batch), _STRINGS)

    return run


def _range_runs(length: int):
    """Hot buckets: (doc_id, mark, begin, at, ranges of distances) -> repeated runs of the document, neighbours as one."""
    def rows(batch):
        for key, mark, begin, at, ranges in zip(*[c.to_pylist() for c in batch.columns]):
            reach = [(begin + at - r["far"], begin + at - r["near"] + length) for r in ranges]
            for lo, hi in _merged(reach):
                yield key, mark, lo, hi

    def run(batches):
        for batch in batches:
            yield from _batches_of(rows(batch), _RUNS)

    return run


def _finer_rows(length: int, starts: int):
    """Hot buckets: contexts (ctx, at, bytes, ranges) -> identifiers of every range cut at multiples of ``starts``."""
    digest = xxhash.xxh3_64_intdigest

    def rows(batch):
        for ctx, at, context, ranges in zip(*[c.to_pylist() for c in batch.columns]):
            for r in ranges:
                for core, extent, near, far in core_ranges(context, at, length, starts, r["near"], r["far"]):
                    yield (digest(core, seed=near // starts) - 2**63, digest(extent, seed=near * (length + 1) + far) - 2**63, ctx, near, far, r["alone"])

    def run(batches):
        for batch in batches:
            yield from _batches_of(rows(batch), _FINER)

    return run


def _sorted_out(ranges: DataFrame, contexts: DataFrame, tag: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``ranges(core, extent, ctx, near, far, alone)``: the whole ones that repeat, and (ctx, at, bytes, ranges) of those still open.

    One range speaks for each extent; it is alone if no other has that extent
    and its strings are not known to repeat already.
    """
    extents = written(ranges.groupBy("core", "extent").agg(
        F.count("*").alias("n"), F.min(F.struct("ctx", "near", "far", "alone")).alias("first")), tag)
    twice = extents.where("n > 1").select("core", "extent")
    whole = ranges.where("alone").join(twice, ["core", "extent"], "left_semi").select("ctx", "near", "far")
    several = extents.groupBy("core").agg(F.count("*").alias("parts")).where("parts > 1").select("core")
    speaking = extents.join(several, "core", "left_semi").select(
        "first.ctx", "first.near", "first.far", (F.col("first.alone") & (F.col("n") == 1)).alias("alone"))
    speaking = speaking.groupBy("ctx").agg(F.collect_list(F.struct("near", "far", "alone")).alias("ranges"))
    return whole, contexts.join(speaking, "ctx").select("ctx", "at", "bytes", "ranges"), extents


def _repeated_ranges(contexts: DataFrame, length: int, starts: int) -> tuple[DataFrame, list[DataFrame]]:
    """(ctx, runs of distances whose strings repeat) for ``contexts(ctx, at, bytes)``, and the tables to discard."""
    fields = "core long, extent long, ctx long, near int, far int"
    ranges = written(contexts.mapInArrow(_core_rows(length, starts), fields), "cores")
    whole, read, extents = _sorted_out(ranges.withColumn("alone", F.lit(True)), contexts, "extents")
    # An edge of a passage lies in one finer range of several: the others are settled whole.
    finer = written(read.mapInArrow(_finer_rows(length, -(-starts // FINER_PARTS)), fields + ", alone boolean"), "finer-cores")
    parts, read, finer_extents = _sorted_out(finer, contexts, "finer-extents")
    each = written(read.mapInArrow(_string_rows(length), "a long, b long, ctx long, near int, alone boolean"), "each")
    twice = each.groupBy("a", "b").count().where("count > 1").select("a", "b")
    single = each.where("alone").join(twice, ["a", "b"], "left_semi").select("ctx", "near", F.col("near").alias("far"))
    found = whole.unionAll(parts).unionAll(single).groupBy("ctx").agg(F.collect_set(F.struct("near", "far")).alias("ranges"))
    return found, [ranges, extents, finer, finer_extents, each]


def _removal(length: int, q: int):
    """(doc_id, text, shared places, runs) -> what is kept."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            rows = []
            for i, key in enumerate(batch.column(0).to_pylist()):
                runs = [(r["lo"], r["hi"]) for r in batch.column(3)[i].as_py() or []]
                rows.append(_kept(key, texts[i].as_py(), batch.column(2)[i].as_py() or [], runs, length, q))
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _KEPT)], schema=_KEPT)

    return run


def repeated_strings(docs: DataFrame, length: int = LENGTH, q: int = QGRAM, id_col: str = "doc_id", text_col: str = "text",
                     hot_contexts: int = HOT_CONTEXTS, starts: int = CORE_STARTS) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256).

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same document or another; ``spans`` are the maximal
    removed runs as [begin, end).  Texts are bytes of UTF-8, null is empty,
    matches never cross documents.  Repeated rows are documents of their own,
    so each is a copy of the other.  Null ids: judged like any row.  Empty
    table: no rows.  Other columns are not read.
    """
    rows = text_rows(docs, id_col, text_col)
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    # Level 1: q-gram buckets; single suffixes are finished.
    counted = rows.mapInArrow(_anchor_rows(length, q, False), "bucket long").groupBy("bucket").count()
    open_ = written(counted.where("count > 1").select(F.col("bucket").alias("b")), "qgrams")
    suffixes = rows.mapInArrow(_anchor_rows(length, q, True), "bucket long, context long, doc_id long, mark long, place long")
    active = written(suffixes.join(open_, suffixes["bucket"] == open_["b"], "left_semi"), "suffixes")
    # Level 2: refined by what lies to both sides.
    refined = written(active.groupBy("bucket", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "place")).alias("first")), "refined")
    split = refined.groupBy("bucket").agg(F.count("*").alias("parts")).where("parts > 1")
    again = refined.join(split, "bucket").select("first.*", "bucket", (F.col("parts") > hot_contexts).alias("hot"))
    shared = active.join(refined.where("n > 1").select("bucket", "context"), ["bucket", "context"])
    per_doc = shared.select("doc_id", "mark", "place", "bucket", F.lit(None).cast("boolean").alias("hot")).unionAll(
        again.select("doc_id", "mark", "place", "bucket", "hot"))
    per_doc = per_doc.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(
        F.collect_set(F.when(F.col("hot").isNull(), F.col("place"))).alias("shared"),
        F.collect_set(F.when(F.col("hot").isNotNull(), F.struct("place", "bucket", "hot"))).alias("open"))
    of = lambda left, right: left["doc_id"].eqNullSafe(right["d"]) & (left["mark"] == right["m"])
    joined = rows.join(per_doc, of(rows, per_doc), "left").select("doc_id", "mark", "text", "shared", "open")
    # Level 3: the strings themselves, where a bucket fell into several.
    kept = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept_sha256 string"
    strings = written(joined.mapInArrow(_open_rows(length, q), "mark long, text string, shared array<long>, "
                                        f"parts array<struct<ctx:long,bucket:long,hot:boolean,begin:long,at:long,bytes:binary>>, {kept}"), "strings")
    parts = strings.select("doc_id", "mark", F.explode("parts").alias("p")).select("doc_id", "mark", "p.*")
    usual = parts.where("NOT hot").select("bucket", "doc_id", "mark", "begin", "at", "bytes").repartition("bucket").sortWithinPartitions("bucket")
    found = usual.mapInArrow(_bucket_rows(length), "doc_id long, mark long, lo long, hi long")
    hot = parts.where("hot")
    repeats, spent = _repeated_ranges(hot.where(F.length("bytes") >= length).select("ctx", "at", "bytes"), length, starts)
    more = hot.select("ctx", "doc_id", "mark", "begin", "at").join(repeats, "ctx").select("doc_id", "mark", "begin", "at", "ranges")
    found = found.unionAll(more.mapInArrow(_range_runs(length), "doc_id long, mark long, lo long, hi long"))
    found = found.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    pending = strings.where("text IS NOT NULL").select("doc_id", "mark", "text", "shared")
    last = pending.join(found, of(pending, found), "left").select("doc_id", "text", "shared", "runs")
    names = _KEPT.names
    out = written(strings.where("text IS NULL").select(*names).unionAll(last.mapInArrow(_removal(length, q), kept).select(*names)), "removed")
    for table in (open_, active, refined, strings, *spent):
        discard(table)
    return out


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(documents(spark, sf_dir)).drop("spans")
