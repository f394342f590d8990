"""Plain versions of the operators' results, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def simhash(text, words=3):
    tokens = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in words_of(text)]
    runs = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(docs, threshold=2, words=3):
    """{row: (fingerprint, smallest id reachable)} of (id, text) rows."""
    prints = [simhash(t, words) for _, t in docs]
    union = Union(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                union.join(i, j)
    least = {}
    for i, (key, _) in enumerate(docs):
        root = union.find(i)
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return [(key, f"{prints[i]:016x}", least.get(union.find(i))) for i, (key, _) in enumerate(docs)]


def repeated(docs, length=200):
    """(id, n_bytes, n_removed, n_spans, sha256 of the rest) of (id, text) rows."""
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter()
    for text in raw:
        for i in range(len(text) - length + 1):
            seen[text[i : i + length]] += 1
    out = []
    for (key, _), text in zip(docs, raw):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if seen[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(text, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((key, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def quality_base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def jump(key, shards):
    key &= 2**64 - 1
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def grouped(pairs):
    out = defaultdict(list)
    for k, v in pairs:
        out[k].append(v)
    return out
