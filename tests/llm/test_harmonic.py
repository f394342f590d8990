"""Harmonic packing: the ids it lays out are the library's, its sequences are whole, nothing is padded that need not be."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from brute import grouped

from ledgerlake.llm import harmonic
from ledgerlake.llm.byte_tokens import BYTE_TOKENIZER, ByteTokens
from ledgerlake.llm.word_tokens import vocabulary_path


@pytest.fixture(scope="module")
def byte_ids():
    tokenizer = ByteTokens.load(vocabulary_path(BYTE_TOKENIZER)).tokenizer
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def sound(rows, docs, byte_ids, capacity):
    """Every id of every document lies in exactly one piece, every sequence is gapless and fits."""
    left = grouped((k, byte_ids(t)) for k, t in docs)
    found = grouped((r.doc_id, r) for r in rows)
    assert set(left) == set(found)
    for key, pieces in found.items():
        at = grouped((r.start, r) for r in pieces)
        assert sum(r.length for r in pieces) == sum(map(len, left[key]))
        for ids in left[key]:  # rows that share an id: any of their pieces may continue
            reached = 0
            while reached < len(ids):
                fits = [r for r in at[reached] if r.doc_tokens == len(ids)
                        and zlib.crc32(np.array(ids[reached : reached + r.length], "<u4").tobytes()) == r.ids_crc32]
                assert fits
                at[reached].remove(fits[0])
                reached += fits[0].length
        assert not any(at.values())
    for pieces in grouped((r.sequence_id, r) for r in rows).values():
        end = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == end and r.length > 0
            end += r.length
        assert end <= capacity


@pytest.mark.parametrize("which", ["odd", "tiny"])
@pytest.mark.parametrize("capacity,least", [(1024, 1), (1024, 1024), (100, 1), (96, 20)])
def test_packing(spark, odd, odd_rows, tiny, tiny_rows, byte_ids, which, capacity, least):
    docs, rows = (odd, odd_rows) if which == "odd" else (spark.read.parquet(f"{tiny}/documents.parquet"), tiny_rows)
    found = harmonic.pack_harmonic(docs, vocabulary_path(BYTE_TOKENIZER), capacity=capacity, least=least)
    sound(found.collect(), rows, byte_ids, capacity)


def test_no_padding_where_documents_may_be_cut(odd, byte_ids, odd_rows):
    """Also with many tasks that each hold few documents."""
    for parts in (1, 13):
        packed = harmonic.pack_harmonic(odd.repartition(parts), vocabulary_path(BYTE_TOKENIZER))
        got = harmonic.padding(packed).first()
        assert got.padding == 0 and got.ids == sum(len(byte_ids(t)) for _, t in odd_rows)


def test_a_class_has_a_fixed_count():
    rng = np.random.default_rng(7)
    bins, rows = harmonic.HarmonicBins(1000, 1, 0, 0), rng.integers(1, 1001, 5000)
    full = bins.add(rows[None, :3000]), bins.add(rows[None, 3000:])
    for length, sequence in ((f[0], f[1]) for f in full):
        for pieces in grouped(zip(sequence.tolist(), length.tolist())).values():
            assert {1000 // p for p in pieces} == {len(pieces)}
    rest = bins.close()
    assert rest.shape[1] + sum(f.shape[1] for f in full) == 5000 and not bins.open
    assert sorted(np.hstack([*full, rest])[0].tolist()) == sorted(rows.tolist())


def test_cuts():
    length, doc = harmonic.cut_lengths(np.array([1, 1024, 1025, 700, 3000]), 1024, 1)
    assert grouped(zip(doc.tolist(), length.tolist())) == {
        0: [1], 1: [1024], 2: [1024, 1], 3: [512, 128, 32, 16, 8, 4], 4: [1024, 1024, 512, 256, 128, 32, 16, 8]}
    length, doc = harmonic.cut_lengths(np.array([700]), 1024, 64)
    assert length.tolist() == [512, 128, 60]


def test_empty(empty):
    found = harmonic.pack_harmonic(empty, vocabulary_path(BYTE_TOKENIZER))
    assert found.count() == 0 and harmonic.padding(found).first().padding == 0
