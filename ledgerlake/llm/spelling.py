"""Operator 12: spelling variants by a variable-length gram index.

Words and their counts are gathered from whole texts.  The gram dictionary
holds the grams that are frequent among the distinct words (a bounded number,
see ``MAX_GRAMS``).  A word, between two end marks, is decomposed at each
place into the shortest gram that is not frequent, up to ``GRAM_MOST``
characters.  A gram's choice looks at its own characters only, so one
inserted, deleted or replaced character changes no gram but those that hold
it; the most grams that hold one character are a word's affected-gram bound.

A word of m grams and bound b keeps at least m - b grams through any edit, so
h of them end before the edit, or m - b + 1 - h begin after it.  In the first
case everything up to the h-th end is the same in both words, in the second
everything from that start on.  A gram's list in the index is therefore split
by the characters before it, and again by those after it; a word merges the
two lists that its bound names, for words of its own size and of one letter
more, and what meets there is verified.  The rarer a word's grams, the shorter
they are, the lower its bound and the longer the context of its two lists.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, text_rows, written

# What a run of letters is, the share of runs that lose a letter, the words and forms asked for.
LETTERS = "A-Za-zÀ-ÿ"
DELETED = 31
LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 7, 2, 10

GRAM_LEAST, GRAM_MOST = 2, 4
# A gram is frequent if more than its share of all grams of its length; fewer than this many can be.
MAX_GRAMS = 100_000
# Lists as short as this need no longer grams.
SHORT_LIST = 32
BEGIN, END = "^", "$"
BATCH_BYTES = 8 << 20
# Distinct words a task holds before it passes their counts on.
HELD_WORDS = 400_000
_FOLD = {c: c + 32 for c in range(65, 91)}


def fold(run: str) -> str:
    """A-Z in lower case, all other characters as they are."""
    return run.lower() if run.isascii() else run.translate(_FOLD)


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all occurrences in whole texts, after the deletions that ``DELETED`` asks for.

    Null text: no words.  Null id: nothing is deleted, as its checksum is not defined.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")  # a shorter run cannot give a word

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not text:
                        continue
                    seed = None if key is None else zlib.crc32(b"%d:" % key)
                    for found, n in Counter(runs.findall(text)).items():
                        word = fold(found)
                        if seed is not None:
                            h = zlib.crc32(word.encode(), seed)
                            if h % DELETED == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least_length:
                                    continue
                        held[word] += n
                if len(held) > HELD_WORDS:
                    yield batch_of(held)
                    held.clear()
        yield batch_of(held)

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, max_grams: int = MAX_GRAMS, short_list: int = SHORT_LIST, most: int = GRAM_MOST) -> dict[str, int]:
    """The gram dictionary: grams met more often than the limit, with their counts.

    Grams of ``GRAM_LEAST`` to ``most - 1`` characters (longer ones are never
    extended) and the words' beginnings and ends from ``most`` characters to
    half the word, the contexts of the index's lists.  The limit is
    ``short_list`` or, if larger, the number of all grams over ``max_grams``:
    fewer than ``max_grams`` can pass it, so the dictionary's size is bounded
    however many words there are.
    """
    marked = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("m")).where(F.length("m") >= most)
    inner = [f"transform(sequence(1, length(m) - {q - 1}), i -> substring(m, i, {q}))" for q in range(GRAM_LEAST, most)]
    outer = [f"transform(sequence({most}, greatest({most}, length(m) div 2 + 1)), i -> {side}(m, i))" for side in ("left", "right")]
    grams = marked.select(F.expr(f"concat({', '.join(inner + outer)})").alias("grams"))
    total = grams.agg(F.sum(F.size("grams")).alias("t")).first().t or 0
    limit = max(short_list, -(-total // max_grams))
    counted = grams.select(F.explode("grams").alias("gram")).groupBy("gram").count()
    return {r.gram: r["count"] for r in counted.where(F.col("count") > limit).collect()}


def decompose(word: str, frequent: dict[str, int], most: int = GRAM_MOST) -> list[int]:
    """Where the gram that begins at each place of the marked word ends."""
    marked, ends = BEGIN + word + END, []
    n = len(marked)
    for at in range(n - GRAM_LEAST + 1):
        end = at + GRAM_LEAST
        while end < n and end - at < most and marked[at:end] in frequent:
            end += 1
        ends.append(end)
    return ends


def affected_bound(ends: list[int]) -> int:
    """Most grams that one edit can change: the most that hold one character."""
    begun = best = 0
    for at, end in enumerate(sorted(ends)):
        while begun < len(ends) and begun < end:
            begun += 1
        best = max(best, begun - at)
    return best


def _half(size: int) -> int:
    """Characters of a marked word that a list's context has at most."""
    return size // 2 + 1


def index_lists(word: str, frequent: dict[str, int], most: int = GRAM_MOST) -> list[str]:
    """The lists a word stands in: each gram with all before it, and each with all after it, up to half the word."""
    marked, ends = BEGIN + word + END, decompose(word, frequent, most)
    half = _half(len(marked))
    return [marked[:end] for end in sorted(set(ends)) if end <= half] + [marked[at:] for at in range(len(marked) - half, len(ends))]


def merged_lists(word: str, frequent: dict[str, int], most: int = GRAM_MOST) -> list[str]:
    """The two lists a word's near words are in: of the grams left by any one edit, so many end before it, or so many begin after it.

    Of the ways to share the bound between the two, the one with the shortest lists.
    """
    marked, ends = BEGIN + word + END, sorted(decompose(word, frequent, most))
    n, half, places = len(marked), _half(len(word) + 2), len(ends)
    spared = places - affected_bound(ends)
    best = None
    for before in range(1, spared + 1):
        end = max(e for e in ends[:before] if e <= half)
        at = max(places - (spared + 1 - before), n - half)
        left, right = marked[:end], marked[at:]
        rank = (frequent.get(left, 0) + frequent.get(right, 0), -min(end, n - at))
        if best is None or rank < best[0]:
            best = rank, [left, right]
    return best[1]


def _letters(word: str) -> int:
    """Two bits per kind of letter (of 32): met, and met again.  An edit takes away one letter at most and adds one: two bits."""
    bits = 0
    for c in word:
        once = 1 << 2 * (ord(c) & 31)
        bits |= once << 1 if bits & once else once
    return bits - (1 << 64) if bits >> 63 else bits


def near_pairs(words: DataFrame, frequent: dict[str, int], most: int = GRAM_MOST) -> DataFrame:
    """(a, b), once each, of distinct words at edit distance one; a is the shorter, or the smaller of equal length.

    ``words(word)`` are distinct, of at least ``most + 1`` characters.
    ``frequent`` is broadcast (bounded, see :func:`frequent_grams`); no table
    is: Spark sizes one by its compressed files, and takes the lists that a
    word stands in for as many rows as words.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def lists_of(kind):
        def run(batches):
            grams = shared.value
            for batch in batches:
                rows: list[tuple[str, int, str, int]] = []
                for word in batch.column(0).to_pylist():
                    letters, size = _letters(word), len(word)
                    rows += [(word, letters, context, size) for context in kind(word, grams, most)]
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int32()))],
                                          names=["word", "letters", "context", "size"])

        return words.select("word").mapInArrow(run, "word string, letters long, context string, size int")

    # A list is known by the checksum of its context and its words' size; two that share one only meet more words to verify.
    index = lists_of(index_lists).select(F.col("word").alias("b"), F.col("letters").alias("b_letters"), F.xxhash64("context", "size").alias("list"))
    longer = F.explode(F.array(F.lit(0), F.lit(1)))
    merged = lists_of(merged_lists).select("word", "letters", "context", "size", longer.alias("longer")).select(
        F.col("word").alias("a"), F.col("letters").alias("a_letters"), "longer", F.xxhash64("context", F.col("size") + F.col("longer")).alias("list"))
    close = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    met = merged.join(index.hint("merge"), (merged["list"] == index["list"]) & close & F.expr("longer = 1 OR a < b"))
    near = met.where(F.levenshtein("a", "b", 1) == 1).where("char_length(a) < char_length(b) OR char_length(a) = char_length(b) AND a < b")
    return near.select("a", "b").distinct()


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: forms followed to the last.

    A form has ten times its word's count or more, so a chain is shorter than
    the digits of the largest count; each round doubles what is followed.
    As in :func:`near_pairs`, no table is broadcast.
    """
    now = forms.select("word", F.col("form").alias("root")).checkpoint()
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        then = now.join(step.hint("merge"), "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")).checkpoint()
        moved = then.where("moved").limit(1).count()
        now = then.drop("moved")
        if not moved:
            return now


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, form_factor: int = FORM_FACTOR,
                      id_col: str = "doc_id", text_col: str = "text", max_grams: int = MAX_GRAMS, short_list: int = SHORT_LIST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of whole texts.

    A word's form is its most frequent near word (ties: the smallest), if that
    is met ``form_factor`` times as often or more, else null; root is the last
    form reached, the word itself if it has none.  Null and empty texts have
    no words, repeated rows count each, an empty table gives no rows, other
    columns are not read.
    """
    words = written(word_counts(docs, least_length, id_col, text_col).where(F.col("n") >= least_count), "words")
    most = min(GRAM_MOST, least_length - 1)
    pairs = written(near_pairs(words, frequent_grams(words, max_grams, short_list, most), most), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionAll(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint("merge"), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    judged = words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.rank") >= form_factor * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.rank")).alias("form_n"))).alias("f"))
    judged = written(judged.select("word", "n", "n_near", "f.form", "f.form_n"), "forms")
    roots = roots_of(judged.where("form IS NOT NULL"))
    return judged.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
