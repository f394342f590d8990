"""Spelling variants against a plain version: every pair of words compared."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import brute
import pytest
from test_operators import bag

from ledgerlake.llm import spelling

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def words_of(docs, least_length=7):
    found = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if key is not None:
                h = zlib.crc32(f"{key}:{word}".encode())
                if h % 31 == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= 2}


def one_edit(a, b):
    """Whether one letter put in, left out or replaced makes ``a`` into ``b``."""
    a, b = sorted((a, b), key=len)
    if a == b or len(b) > len(a) + 1:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


def near_words(words):
    """Every two words that are equal but for one letter, through all deletions of one letter."""
    holes = brute.grouped((w[:i] + hole + w[i + 1 :], w) for w in words for i in range(len(w)) for hole in ("", "*"))
    near = {w: set() for w in words}
    for made, ws in holes.items():
        near_here = set(ws) | ({made} & near.keys())
        for a in near_here:
            near[a] |= {b for b in near_here if one_edit(a, b)}
    return near


def variants(docs):
    words = words_of(docs)
    near, forms = near_words(words), {}
    for w, ns in near.items():
        if ns:
            best = min(ns, key=lambda x: (-words[x], x))
            if words[best] >= 10 * words[w]:
                forms[w] = best
    out = []
    for w in words:
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.append((w, form, root, words[w], len(near[w]), words.get(form)))
    return Counter(out)


def test_plain_near_words_are_all_pairs():
    rng = random.Random(2)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(7, 9))) for _ in range(150)}
    assert near_words(words) == {a: {b for b in words if brute.levenshtein(a, b) == 1} for a in words}


def test_odd_rows_and_small_table(spark, odd, odd_rows, tiny, tiny_rows):
    assert bag(spelling.spelling_variants(odd), *COLUMNS) == variants(odd_rows)
    found = spelling.spelling_variants(spark.read.parquet(f"{tiny}/documents.parquet"))
    assert bag(found, *COLUMNS) == variants(tiny_rows)


@pytest.mark.parametrize("short_list", [1, 20, 10_000])
def test_many_near_words(spark, short_list):
    """Chains of forms, words made of few letters, Latin-1 letters; the dictionary from nearly all grams to none."""
    rng = random.Random(short_list)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 12))) for _ in range(60)]
    texts = []
    for k, word in enumerate(base):
        for level, times in ((0, 300), (1, 25), (2, 2)):
            for _ in range(1 + level):
                changed = word
                for _ in range(level):
                    at = rng.randrange(len(changed))
                    changed = rng.choice([changed[:at] + changed[at + 1 :], changed[:at] + "z" + changed[at:], changed[:at] + "q" + changed[at + 1 :]])
                texts.append((len(texts) * 7 + k, " ".join([changed.upper() if level == 0 and k % 2 else changed] * times)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    found = spelling.spelling_variants(docs, short_list=short_list)
    want = variants(texts)
    assert bag(found, *COLUMNS) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_near_words_meet_in_a_merged_list():
    rng = random.Random(5)
    for _ in range(20_000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(5, 14)))
        at = rng.randrange(len(a))
        b = rng.choice([a[:at] + rng.choice("abc") + a[at:], a[:at] + rng.choice("abc") + a[at + 1 :]])
        if a == b:
            continue
        grams = {x + y: rng.randint(1, 9) for x in "^abc" for y in "abc$" if rng.random() < 0.6}
        grams |= {g + y: rng.randint(1, 9) for g in list(grams) for y in "abc$" if rng.random() < 0.5}
        assert set(spelling.merged_lists(a, grams)) & set(spelling.index_lists(b, grams)), (a, b, grams)


def test_affected_bound_is_of_one_character():
    rng = random.Random(6)
    for _ in range(2000):
        n = rng.randint(3, 20)
        ends = [min(n, at + rng.randint(2, 4)) for at in range(n - 1)]
        assert spelling.affected_bound(ends) == max(sum(at <= e < end for at, end in enumerate(ends)) for e in range(n))


def test_empty(empty):
    assert spelling.spelling_variants(empty).count() == 0


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame([("".join(random.Random(k).choices("abcdefgh", k=9)),) for k in range(3000)], "word string").distinct()
    for most in (10, 200):
        assert len(spelling.frequent_grams(words, max_grams=most, short_list=0)) < most


def test_no_table_of_words_is_broadcast(spark):
    """A few tiny tables, which Spark would broadcast; the lists of many words are larger than they look."""
    docs = spark.createDataFrame([(k, "kingdoms kingdom " * 3 + "kingdomz " * 40) for k in range(4)], "doc_id long, text string")
    words = spark.createDataFrame([("kingdom",), ("kingdoms",)], "word string")
    forms = spark.createDataFrame([("kingdoms", "kingdomz")], "word string, form string")
    for found in (spelling.spelling_variants(docs), spelling.near_pairs(words, {}), spelling.roots_of(forms)):
        assert found.count()
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
