"""Periodic runs and common extensions against plain versions."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import words_of
from test_operators import bag

from ledgerlake.llm import periodic_runs
from ledgerlake.llm.recompression import Grammar

COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def plain_runs(words, least=12):
    """(start, length, period) by start, then period: for each period, every stretch that keeps it, once with its smallest."""
    best = {}
    n = len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                best.setdefault((i, j + p - i), p)
            i = j
    return sorted((s, length, p) for (s, length), p in best.items())


def plain_row(key, text):
    words = words_of(text)
    n = len(words)
    if key is not None and n:
        h = zlib.crc32(str(key).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (key, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def texts_with_runs():
    rng = np.random.default_rng(11)
    out = []
    for k in range(400):
        n = int(rng.integers(0, 120))
        kind = k % 5
        if kind == 0:
            words = rng.integers(0, 2, n)
        elif kind == 1:
            words = np.resize(rng.integers(0, 3, 1 + n // 7), n)
        elif kind == 2:
            words = np.concatenate([np.resize(rng.integers(0, 50, 1 + int(rng.integers(0, 9))), int(rng.integers(5, 40))) for _ in range(4)])
        elif kind == 3:
            words = np.zeros(n, int)
        else:
            words = rng.integers(0, 200, n)
            words[n // 2 :] = words[: n - n // 2]
        out.append((k, "  ".join(f"w{w}" for w in words)))
    return out


@pytest.mark.parametrize("which", ["odd", "tiny", "made"])
def test_runs(spark, odd, odd_rows, tiny, tiny_rows, which):
    if which == "odd":  # the plain version is quadratic: the 20,000 words are checked by the next test
        docs, rows = odd.where("doc_id IS NULL OR doc_id <> 11"), [r for r in odd_rows if r[0] != 11]
    elif which == "tiny":
        docs, rows = spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows
    else:
        rows = texts_with_runs()
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = periodic_runs.digests(periodic_runs.periodic_runs(docs, planted=True))
    assert bag(found, *COLUMNS) == Counter(plain_row(*r) for r in rows)


def test_long_rows(spark):
    rng = np.random.default_rng(3)
    period = " ".join(f"w{i}" for i in rng.integers(0, 300, 7000))
    rows = [(1, "same " * 300_000), (2, " ".join([period] * 9) + " w1 w2"), (3, " ".join(f"w{i * 7919 % 1000}" for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.periodic_runs(docs).collect()}
    assert found[1] == [(0, 300_000, 1)] and (0, 20_000, 1000) in found[3]
    assert max(found[2], key=lambda r: r[1])[::2] == (0, 7000) and 63_000 <= max(r[1] for r in found[2]) <= 63_002


def test_candidates_within_known_runs(monkeypatch):
    """Found in many small turns, or without sparing covered candidates: the same runs."""
    rng = np.random.default_rng(9)
    codes = np.concatenate([np.resize(rng.integers(0, 4, rng.integers(1, 30)), 400) for _ in range(12)])
    first = np.array([0, 1000, 1000, 1003, 4800])
    want = periodic_runs.runs_of(codes, first)
    for held, cover in ((50, 20), (50, 10**9), (1 << 20, 64)):
        monkeypatch.setattr(periodic_runs, "HELD_CANDIDATES", held)
        monkeypatch.setattr(periodic_runs, "COVER_LENGTH", cover)
        assert (periodic_runs.runs_of(codes, first) == want).all()
    plain = [(lo + s, lo + s + n, p) for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()) for s, n, p in plain_runs(codes[lo:hi].tolist())]
    assert sorted(plain) == sorted(map(tuple, want.T.tolist()))


@pytest.mark.parametrize("seed", range(4))
def test_common_extensions(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        n = int(rng.integers(1, 160))
        s = [rng.integers(0, 2, n), np.resize(rng.integers(0, 3, 6), n), np.zeros(n, int), np.resize(rng.integers(0, 30, 40), n)][seed].tolist()
        x, y = np.sort(rng.integers(0, n, (2, 100)), 0)
        x, y = x[x < y], y[x < y]
        grammar = Grammar(np.array(s))
        forward, backward = grammar.forward(x, y).tolist(), grammar.backward(x, y).tolist()
        for i, j, f, b in zip(x.tolist(), y.tolist(), forward, backward):
            assert s[i : i + f] == s[j : j + f] and (j + f == n or s[i + f] != s[j + f])
            assert s[i - b : i] == s[j - b : j] and (i == b or s[i - b - 1] != s[j - b - 1])


def test_empty(empty):
    assert periodic_runs.periodic_runs(empty).count() == 0
