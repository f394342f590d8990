"""Each operator against its plain version, on odd rows, an empty table and the smallest test table."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlake.llm import byte_bpe, exact_dedup, line_dedup, packing, quality_rules, registry, sharding, simhash, suffix_dedup, token_store
from ledgerlake.llm.common import connected_components, scratch
from ledgerlake.llm.word_tokens import WordTokens, vocabulary_path


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def word_ids():
    tokenizer = WordTokens.load(vocabulary_path()).tokenizer
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


# 10 SimHash

@pytest.mark.parametrize("which", ["odd", "tiny"])
def test_simhash(spark, odd, odd_rows, tiny, tiny_rows, which):
    docs, rows = (odd, odd_rows) if which == "odd" else (spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows)
    found = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id")
    assert bag(found, "doc_id", "f", "component_id") == Counter(brute.simhash_components(rows))


def test_simhash_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_every_close_pair_meets_at_a_home():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 300, dtype=np.uint64)
    x[0], x[1] = 0, 2**64 - 1
    home = simhash.home_anchors(x)
    assert np.bitwise_count(x ^ home).max() <= 12
    for threshold in (1, 2, 3):
        for f, h, s in zip(x.tolist(), home.tolist(), zip(*simhash.syndromes(x))):
            near = set(simhash.near_anchors(f, h, s, threshold).view(np.uint64).tolist())
            flips = rng.choice(64, threshold, replace=False)
            other = f ^ int(sum(1 << int(b) for b in flips))
            assert int(simhash.home_anchors(np.array([other], np.uint64))[0]) in near


def test_links_of_random_fingerprints(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64).tolist()
    prints = sorted({b ^ int(sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 5), replace=False))) for b in base for _ in range(5)})
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    found = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 203), (203, 204), (204, 205)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 203: 203, 204: 203, 205: 203}


# 9 suffix array

@pytest.mark.parametrize("which", ["odd", "tiny"])
def test_repeated_strings(spark, odd, odd_rows, tiny, tiny_rows, which):
    docs, rows = (odd, odd_rows) if which == "odd" else (spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows)
    found = suffix_dedup.repeated_strings(docs)
    assert bag(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.repeated(rows))


@pytest.mark.parametrize("hot,starts", [(suffix_dedup.HOT_CONTEXTS, 4), (2, 4), (1, suffix_dedup.CORE_STARTS)])
def test_repeated_strings_of_a_small_alphabet(spark, hot, starts):
    rng = np.random.default_rng(4)
    base = "".join(rng.choice(list("abcé"), 400))
    rows = [(i, base[int(rng.integers(0, 300)):][: int(rng.integers(0, 90))] + "".join(rng.choice(list("abcé"), int(rng.integers(0, 50))))) for i in range(60)]
    rows += [(100, "ab" * 60), (101, "c" * 30), (102, "c" * 19), (103, base), (103, base)]
    found = suffix_dedup.repeated_strings(spark.createDataFrame(rows, "doc_id long, text string"), length=20, q=6, hot_contexts=hot, starts=starts)
    assert bag(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.repeated(rows, 20))


def test_repeated_strings_of_hot_buckets_alone(spark, tiny, tiny_rows):
    found = suffix_dedup.repeated_strings(spark.read.parquet(f"{tiny}/documents.parquet"), hot_contexts=1)
    assert bag(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.repeated(tiny_rows))


def test_only_the_edges_of_a_passage_are_counted_string_by_string(spark):
    """Fifty contexts of one passage: the strings at distances 52 to 100 repeat, and one finer range at either edge is taken apart."""
    rng = np.random.default_rng(6)
    passage = rng.bytes(248)
    rows = [(k, 160, rng.bytes(60) + passage + rng.bytes(60)) for k in range(50)]
    found, tables = suffix_dedup._repeated_ranges(spark.createDataFrame(rows, "ctx long, at long, bytes binary"), 200, 24)
    assert {(r.ctx, d) for r in found.collect() for x in r.ranges for d in range(x.near, x.far + 1)} == {(k, d) for k in range(50) for d in range(52, 101)}
    assert tables[-1].count() == 50 * 2 * 6  # 24 each without the finer ranges


def test_repeated_strings_empty(empty):
    assert suffix_dedup.repeated_strings(empty).count() == 0


# 8 quality rules

@pytest.mark.parametrize("which", ["odd", "tiny"])
def test_measures(spark, odd, odd_rows, tiny, tiny_rows, which):
    docs, rows = (odd, odd_rows) if which == "odd" else (spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows)
    found = quality_rules.measures(docs).withColumn("failed", quality_rules.base_failed())
    want = Counter((k, *brute.quality_base(t)) for k, t in rows)
    assert bag(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed") == want


def test_many_repeated_windows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(12)], 3000))) for i in range(3)]
    found = quality_rules.measures(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(found, "doc_id", "n_repeat_words") == Counter((k, brute.quality_base(t)[4]) for k, t in rows)


def test_binomial_tail(spark):
    from math import comb

    cases = [(n, k, p) for n in (1, 5, 60, 400) for k in (0, 1, 3, 7) if k <= n for p in (0.004, 0.02, 0.3)]
    for p in {c[2] for c in cases}:
        rows = [(n, k) for n, k, q in cases if q == p]
        got = spark.createDataFrame(rows, "n long, k long").select("n", "k", quality_rules.binomial_tail(F.col("n"), F.col("k"), p).alias("t")).collect()
        for r in got:
            want = sum(comb(r.n, i) * p**i * (1 - p) ** (r.n - i) for i in range(r.k + 1)) if r.k < r.n * p else 1.0
            assert abs(r.t - want) <= 1e-9 * want


def test_cutoffs_hold_the_risk(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(6000):
        good = i % 4 > 0
        marks = rng.poisson(1 if good else 40)
        rows.append((i, " ".join(f"word{(i + k) % 997}" for k in range(80)) + "#" * int(marks), "s" + str(i % 2), good))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good boolean")
    found = quality_rules.quality_rules(docs, docs.select("doc_id", "good")).join(docs.select("doc_id", "good"), "doc_id")
    rates = {r.good: r.rate for r in found.where("NOT base_failed").groupBy("good").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rates[True] >= 1 - quality_rules.RISK and rates[False] <= 0.2


def test_cutoffs_against_sql(spark):
    """Enough labels that cutoffs are certified in some strata and not in others."""
    import duckdb

    rng = np.random.default_rng(13)
    rows = []
    for i in range(4000):
        stratum = ("big", "big", "big", "small", None)[i % 5]
        good = bool(rng.random() < 0.8)
        text = " ".join("w" * int(rng.integers(2, 6) + (0 if good else 2)) + str((i * 31 + k * k) % 4999) for k in range(60))
        rows.append((i, text + "#" * int(rng.poisson(0.2 if good else 12)) + "\nx y z\nx y z" * int(rng.random() < 0.01), stratum, good))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    found = quality_rules.quality_rules(docs, spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, good boolean")).drop("stratum")
    con = duckdb.connect()
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": [r[2] for r in rows]})  # noqa: F841
    labels = pa.table({"doc_id": [r[0] for r in rows], "quality": [int(r[3]) for r in rows]})  # noqa: F841
    want = con.execute(registry.ORACLE_SQL["op8_quality_rules"])
    columns = [d[0] for d in want.description]
    assert bag(found, *columns) == Counter(want.fetchall())
    gone = {r.doc_id for r in found.where("NOT kept").collect()}
    rejected = Counter((r[2], r[3]) for r in rows if r[0] in gone)
    assert rejected["big", False] > 200 and rejected["big", True] <= 0.02 * 1900


def test_no_labels_no_cutoffs(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, good boolean")
    found = quality_rules.quality_rules(odd, none)
    assert found.count() == odd.count() and found.where("kept = base_failed").count() == 0
    assert quality_rules.quality_rules(empty, none).count() == 0


# 7 sharding

def test_sharding(odd, odd_rows, empty):
    found = sharding.shard_documents(odd).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in odd_rows)
    for shard, slots in brute.grouped((r.shard, r.slot) for r in found).items():
        assert 0 <= shard < 8 and sorted(slots) == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in found)
    assert all(len(set(v)) == 1 for v in brute.grouped((r.doc_id, r.shard) for r in found).values())
    assert sharding.shard_documents(empty).count() == 0


def test_jump_hash():
    keys = np.random.default_rng(3).integers(0, 2**64, 500, dtype=np.uint64)
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump_shards(keys, shards).tolist() == [brute.jump(int(k), shards) for k in keys]


# 6 byte-level BPE

def test_byte_bpe(spark, odd, odd_rows, tiny, tiny_rows, empty):
    path = P.path(byte_bpe.BYTE_VOCABULARY)
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    for docs, rows in ((odd, odd_rows), (spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows)):
        found = byte_bpe.digests(byte_bpe.encode_decode(docs, path, P.PATTERN))
        want = Counter()
        for k, t in rows:
            ids = plain.encode_ordinary(t or "")
            want[k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
        assert bag(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert byte_bpe.encode_decode(empty, path, P.PATTERN).count() == 0


def test_one_queue_for_many_words_and_long_ones():
    bpe = byte_bpe.ByteBpe.load(P.path(byte_bpe.BYTE_VOCABULARY), P.PATTERN)
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("aabeé t中"), int(rng.integers(1, 40)))).encode() for _ in range(800)]
    words += [b"a" * 4001, b"ab" * 999, " ".join(["the"] * 50).encode(), b"\xff\x00" * 33]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(words)] == [bpe.merge(w) for w in words]


def test_ranks_that_no_training_gives():
    """A pair whose rank is lower than that of a merge that makes it: done alone, by the scalar queue."""
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bc": 257, b"cd": 258}
    bpe = byte_bpe.ByteBpe(ranks, r".+")
    words = [b"abcd", b"abcabc", b"bcd", b"xabcx"]
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.merge_many(words)] == [bpe.merge(w) for w in words]


# 5 exact dedup

@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 3000])
def test_exact_dedup(odd, odd_rows, empty, table_bytes):
    found = exact_dedup.exact_duplicates(odd, table_bytes=table_bytes, bucket_bytes=8000 if table_bytes < 10_000 else exact_dedup.BUCKET_BYTES)
    groups = brute.grouped(((t or ""), k) for k, t in odd_rows)
    want = Counter()
    for k, t in odd_rows:
        ids = groups[t or ""]
        want[k, max((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert bag(found, "doc_id", "keep_id", "group_size", "text_sha256") == want
    assert found.where("kept").count() == len(groups)
    assert found.where("kept AND NOT doc_id <=> keep_id").count() == 0
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_exact_dedup_of_null_ids(spark):
    docs = spark.createDataFrame([(None, "same"), (None, "same"), (3, "other")], "doc_id long, text string").repartition(2)
    found = exact_dedup.exact_duplicates(docs)
    assert bag(found, "doc_id", "keep_id", "kept") == Counter({(None, None, True): 1, (None, None, False): 1, (3, 3, True): 1})


# 4 packing

def check_packing(found, rows, word_ids):
    want = Counter()
    for k, t in rows:
        ids = [*word_ids(t), packing.END_ID]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[start : start + 4096], "<u4")
            want[k, piece, start, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    bins = brute.grouped((r.sequence_id, (r.offset, r.length)) for r in found)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    return len(bins), -(-sum(r.length for r in found) // 4096)


def test_packing(spark, odd, odd_rows, tiny, tiny_rows, empty, word_ids):
    check_packing(packing.pack_documents(odd, vocabulary_path()).collect(), odd_rows, word_ids)
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    used, least = check_packing(packing.pack_documents(docs, vocabulary_path()).collect(), tiny_rows, word_ids)
    assert used <= least + 1
    assert packing.pack_documents(empty, vocabulary_path()).count() == 0


def test_rounds_pool_what_stays_underfull(spark):
    rng = np.random.default_rng(9)
    pieces = spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(rng.integers(1, 900, 1500))], "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(pieces, group_pieces=200)
    bins = found.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert bins.where("fill <> end OR fill > 4096").count() == 0 and found.count() == 1500
    assert bins.count() <= -(-found.agg(F.sum("length")).first()[0] // 4096) + 1


def test_local_search_empties_bins_that_best_fit_leaves():
    rng = np.random.default_rng(10)
    better = 0
    for _ in range(60):
        lengths = rng.integers(20, 60, 40)
        start = packing.best_fit(lengths, 100)
        bins = packing.local_search([list(b) for b in start], lengths, 100)
        assert sorted(i for b in bins for i in b) == list(range(40)) and all(lengths[b].sum() <= 100 for b in bins)
        assert len(bins) <= len(start)
        better += len(bins) < len(start)
    assert better > 0


def test_rounds_end_when_nothing_pairs_up(spark):
    """Pieces of over half a sequence each: no two fit together, in any round."""
    pieces = spark.createDataFrame([(i, 0, 0, 2100 + i % 900, i) for i in range(900)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = packing.pack(pieces, group_pieces=100)
    assert found.count() == found.select("sequence_id").distinct().count() == 900


# 2 token store

def test_token_store(spark, odd, odd_rows, empty, word_ids):
    folder = scratch(spark, "store")
    manifest = token_store.write_store(odd, folder, vocabulary_path(), docs_per_shard=5)
    assert len(manifest) > 1
    found = token_store.read_keys(odd, folder).collect()
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at, want = 0, Counter()
    for k, t in ordered:
        ids = [*word_ids(t), token_store.END_ID]
        want[k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        at += len(ids)
    assert Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found) == want
    absent = spark.createDataFrame([(k,) for k in (-5, 77, 10**12)], "doc_id long")
    assert token_store.read_keys(absent, folder).count() == 0
    nothing = scratch(spark, "store")
    assert token_store.write_store(empty, nothing, vocabulary_path()) == []
    assert token_store.read_keys(absent, nothing).count() == 0


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(11).integers(-(2**63), 2**63 - 1, 20_000))
    mph = token_store.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    assert token_store.PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


# 1 line dedup

def test_fuzzy_lines(spark, empty):
    base = "the quick brown fox jumps over the lazy dog while the sun sets behind the distant blue hills of home and everyone goes to sleep"
    lines = [base, base.upper(), base.replace("quick", "quickk"), base.replace("dog", "dogs") + "!", "something else entirely", "", "---", "page 12 of 90", "Page 13 of 91"]
    docs = [(1, "\n".join(lines)), (2, "\n".join([base, "one more line", base])), (3, None), (None, base), (2, "\n".join([base, "one more line", base]))]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)).collect()
    rows = [(k, i, line_dedup.normalised(x.encode()).decode()) for k, t in docs if t for i, x in enumerate(t.split("\n"))]
    rows = [r for r in rows if r[2]]
    prints = {n: np.uint64(line_print(n)) for _, _, n in rows}
    union = brute.Union(list(prints))
    for a in prints:
        for b in prints:
            if int(prints[a] ^ prints[b]).bit_count() <= 3 and brute.levenshtein(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
                union.join(a, b)
    size = Counter(union.find(n) for _, _, n in rows)
    assert Counter((r.doc_id, r.line_no, r.group_size) for r in found) == Counter((k, i, size[union.find(n)]) for k, i, n in rows)
    assert sum(r.kept for r in found) == len(size)
    least = {}
    for k, i, n in rows:
        g = union.find(n)
        least[g] = min(least.get(g, (True, 0, 0)), (k is None, k or 0, i))
    assert {(r.keep_doc_id, r.keep_line_no) for r in found} == {(k, i) for _, k, i in least.values()}
    assert line_dedup.fuzzy_lines(empty).count() == 0


def line_print(normal):
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 1) for w in normal.split(" ")], np.uint64)
    return simhash.bit_majority(hashes, np.array([0, len(hashes)]))[0]


def test_any_number_of_blocks_finds_the_same(spark):
    rng = np.random.default_rng(12)
    base = rng.integers(0, 2**63, 30).tolist()
    prints = sorted({b ^ int(sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 4), replace=False))) for b in base for _ in range(4)})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    for blocks in (4, 5, 6):
        keyed = df.select("fp", F.explode(line_dedup.block_keys(F.col("fp"), blocks, 3)).alias("key"))
        pairs = keyed.toDF("a", "key").join(keyed.toDF("b", "key"), "key").where("a < b AND bit_count(a ^ b) <= 3").distinct()
        assert {tuple(r) for r in pairs.select("a", "b").collect()} == want


def test_lines_are_taken_out(spark):
    docs = spark.createDataFrame([(1, "first line here\nsecond line there\nfirst line here"), (2, "second line there"), (3, None)], "doc_id long, text string")
    left = line_dedup.without_repeats(docs, line_dedup.fuzzy_lines(docs))
    assert {(r.doc_id, r.text) for r in left.collect()} == {(1, "first line here\nsecond line there"), (2, ""), (3, None)}


def test_links_by_edit_similarity_alone(spark):
    """Against brute force without any fingerprint: no false link, and at least 95 % of the lines in their whole group."""
    rng = np.random.default_rng(4)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 10))) for _ in range(400)]
    lines = ["quick", "quickk", "lazy dogs", "lazy dog", "-----", "-----", "------"]
    for size in (5, 12, 20, 40):
        for _ in range(15):
            base = [words[k] for k in rng.integers(0, 400, size)]
            at = int(rng.integers(0, size))
            lines += [" ".join(base), " ".join([*base[:at], base[at] + "q", *base[at + 1 :]])]
    docs = [(k, x) for k, x in enumerate(lines)]
    found = line_dedup.fuzzy_lines(spark.createDataFrame(docs, "doc_id long, text string"), max_bits=None).collect()
    union = brute.Union(range(len(lines)))
    plain = [line_dedup.normalised(x.encode()).decode() for x in lines]
    for i, a in enumerate(plain):
        for j, b in enumerate(plain[:i]):
            most = int(0.2 * max(len(a), len(b)) + 1e-9)
            if a == b or (a.strip("-") and abs(len(a) - len(b)) <= most and brute.levenshtein(a, b) <= most):
                union.join(i, j)
    want = Counter(union.find(i) for i in range(len(lines)))
    assert len(found) == len(lines) and all(union.find(r.doc_id) == union.find(r.keep_doc_id) for r in found)
    assert sum(r.group_size == want[union.find(r.doc_id)] for r in found) >= 0.95 * len(lines)


def test_profiles_never_part_close_lines(spark):
    """Against the edit distance: no pair within it is told apart, and of unrelated lines of like letters most are."""
    rng = np.random.default_rng(8)
    parts = ["the", "ation", "er", "ing", "nd", "é", "ble", "wh", "s"]
    lines = ["", "a"]
    for _ in range(60):
        base = list(" ".join("".join(parts[k] for k in rng.integers(0, 9, 3)) for _ in range(int(rng.integers(1, 8)))))
        lines.append("".join(base))
        for _ in range(int(rng.integers(1, 6))):
            at = int(rng.integers(0, len(base)))
            base[at : at + int(rng.integers(0, 2))] = "x" * int(rng.integers(0, 2))
        lines.append("".join(base))
    most = lambda a, b: int(0.2 * max(len(a), len(b)) + 1e-9)
    pairs = [(i, j) for i, a in enumerate(lines) for j, b in enumerate(lines[:i]) if abs(len(a) - len(b)) <= most(a, b)]
    signs = line_dedup.profiles(lines).tolist()
    df = spark.createDataFrame([(i, j, signs[i], signs[j], most(lines[i], lines[j])) for i, j in pairs], "i int, j int, pa array<long>, pb array<long>, most int")
    passed = {(r.i, r.j) for r in df.where(line_dedup.may_be_close("pa", "pb", F.col("most"))).collect()}
    linked = {(i, j) for i, j in pairs if brute.levenshtein(lines[i], lines[j]) <= most(lines[i], lines[j])}
    assert linked and linked <= passed and len(passed) < 0.3 * len(pairs)


def test_lines_of_marks_are_grouped_exactly(spark):
    docs = spark.createDataFrame([(1, "-----\n* * *\n \n-----"), (2, "====\n*  * *")], "doc_id long, text string")
    for bits in (None, 3):
        found = {(r.doc_id, r.line_no): (r.group_size, r.kept) for r in line_dedup.fuzzy_lines(docs, max_bits=bits).collect()}
        assert found == {(1, 0): (2, True), (1, 1): (2, True), (1, 3): (2, False), (2, 0): (1, True), (2, 1): (2, False)}


# Oracle SQL

@pytest.mark.parametrize("key", sorted(registry.ORACLE_SQL))
def test_oracle(spark, tiny, key):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tiny}/{table}.parquet')")
    want = con.execute(registry.ORACLE_SQL[key])
    columns = [d[0] for d in want.description]
    found = registry.QUERIES[key](spark, tiny)
    assert sorted(found.columns) == sorted(columns)
    assert bag(found, *columns) == Counter(want.fetchall())
