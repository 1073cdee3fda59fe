"""Token files, counts and packing against the tokenizers library."""

import functools
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from propensa.llm import packing, token_count, token_file
from propensa.llm.elias_fano import EliasFano
from propensa.llm.tokenizer import CACHE_WORDS, WordTokenizer, word_tokenizer
from tests.llm.data import EDGES, table

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


library = functools.cache(Tokenizer.from_file)


def ids(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=300))
def test_elias_fano_selects_every_value(values):
    values = sorted(values)
    code, used = EliasFano.from_bytes(memoryview(EliasFano.of(np.array(values, np.int64)).to_bytes() + b"rest"))
    assert used == len(EliasFano.of(np.array(values, np.int64)).to_bytes())
    assert code.select(np.arange(len(values))).tolist() == values


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(0, 2000, 10_000))
    assert len(EliasFano.of(values).to_bytes()) * 8 / len(values) < 2 + np.log2(1000) + 3


TEXTS = st.text(st.sampled_from("aAbzé ß'st\n\t\r 0159.,!-²½ª日́  \x1c’“<|>endoftext"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_encode_as_the_library(text):
    for path in (BYTE, WORD):
        assert word_tokenizer(path).encode([text])[0] == np.array(ids(path, text), "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_merging_counts_as_the_library(text):
    assert token_count.merge_table(BYTE).count([text]) == [len(ids(BYTE, text))]


def test_words_turn_over_generations():
    tokenizer = word_tokenizer(BYTE)
    tokenizer.cache.clear()
    tokenizer.cache.limit, before = 3, tokenizer.cache.limit
    try:
        for text in ("one two three four five", "five six one", "one two five", "seven"):
            assert tokenizer.encode([text])[0] == np.array(ids(BYTE, text), "<u4").tobytes()
    finally:
        tokenizer.cache.limit = before


def test_size_of_a_generation_is_the_callers():
    """The token file holds more words than packing; few words of library
    calls, and never more words than asked for."""
    text = " ".join(f"wörd{i} x{i} it's, {i}" for i in range(40))
    small, large = WordTokenizer(BYTE, 5), WordTokenizer(BYTE, 1000)
    for tokenizer, learned in ((small, True), (large, False)):
        first, again = tokenizer.encode([text])[0], []
        tokenizer.cache.learn = lambda word: again.append(word) or tokenizer.ids_of(word)
        assert first == tokenizer.encode([text])[0] == np.array(ids(BYTE, text), "<u4").tobytes()
        assert bool(again) == learned
    assert len(small.cache) <= 5 and len(small.cache.old) <= 5
    assert token_file.WORDS > CACHE_WORDS


def test_token_file_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK_IDS", 50)     # several blocks
    rows = token_file.read_tokens(token_file.write_tokens(table(spark, EDGES), BYTE, 2)).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in EDGES), key=lambda i: (i is not None, i))
    expected = Counter()
    for i, text in EDGES:
        got = np.array([*ids(BYTE, text), 2], "<u4")
        expected[i, len(got), zlib.crc32(got.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]


def test_token_file_of_an_empty_table(spark):
    assert token_file.read_tokens(token_file.write_tokens(table(spark, []), BYTE, 2)).collect() == []


def test_counts(spark):
    got = Counter(map(tuple, token_count.count_tokens(table(spark, EDGES), BYTE).collect()))
    assert got == Counter((i, len((t or "").encode()), len(ids(BYTE, t))) for i, t in EDGES)
    assert token_count.count_tokens(table(spark, []), BYTE).collect() == []


def packed_right(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by)


@pytest.mark.parametrize("slices", [packing.SLICE, 2])
def test_packing(spark, monkeypatch, slices):
    monkeypatch.setattr(packing, "SLICE", slices)
    rows = packing.pack(table(spark, EDGES), WORD, 0, 64).collect()
    expected = Counter()
    for i, text in EDGES:
        got = np.array([*ids(WORD, text), 0], "<u4")
        for piece, at in enumerate(range(0, len(got), 64)):
            part = got[at:at + 64]
            expected[i, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    total = sum(r["length"] for r in rows)
    assert packed_right(rows, 64) <= -(-total // 64) + 1
    assert packing.pack(table(spark, []), WORD, 0, 64).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_uses_every_length_once(lengths):
    histogram = np.bincount(lengths, minlength=65)
    patterns = packing.plan(histogram, 64)
    used = np.zeros(65, np.int64)
    for pattern, times in patterns:
        assert sum(a * b for a, b in pattern) <= 64
        for length, many in pattern:
            used[length] += many * times
    assert (used == histogram).all()
    places = packing.slots(patterns)
    taken = set()
    for length in set(lengths):
        n = int(histogram[length])
        sequence, offset = packing.place(np.full(n, length), np.arange(n), places)
        for s, o in zip(sequence, offset):
            spots = {(s, o + k) for k in range(length)}
            assert not spots & taken
            taken |= spots
