"""Suffix arrays, and removal of repeats against a plain count of windows."""

import hashlib
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from propensa.llm import repeats
from propensa.llm.suffix_array import permuted_lcp, suffix_array
from tests.llm.data import EDGES, prose, table


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.integers(1, 3))
def test_suffixes_and_common_prefixes(values, times):
    values = values * times
    array = suffix_array(np.array(values), 4)
    expected = sorted(range(len(values)), key=lambda i: values[i:])
    assert array.tolist() == expected
    common = permuted_lcp(np.array(values), array)
    for a, b in zip(expected, expected[1:]):
        n = 0
        while max(a, b) + n < len(values) and values[a + n] == values[b + n]:
            n += 1
        assert common[b] == n


def test_many_names_take_digits(monkeypatch):
    from propensa.llm import suffix_array as module

    monkeypatch.setattr(module, "DIRECT", 4)
    values = np.random.default_rng(2).integers(0, 50, 3000)
    values = np.concatenate([values, values[500:1500]])
    assert suffix_array(values, 50).tolist() == sorted(range(len(values)), key=lambda i: values[i:].tolist())


def plain(rows, length):
    """n_bytes, n_removed, n_spans, sha256 of what is left, and that, of each row."""
    texts = [(t or "").encode() for _, t in rows]
    places = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places.setdefault(t[i:i + length], []).append((k, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for k, i in found:
                gone[k][i:i + length] = True
    out = []
    for (i, _), t, g in zip(rows, texts, gone):
        starts = int((np.diff(np.concatenate([[0], g.view(np.int8)])) == 1).sum())
        left = bytes(np.frombuffer(t, np.uint8)[~g])
        out.append((i, len(t), int(g.sum()), starts, hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
    return Counter(out)


def passages():
    """Passages shared in different surroundings, cut at different places."""
    shared = [prose(100 + k, 60) for k in range(3)]
    rows = [(100 + k, prose(k, 30) + shared[k % 3][k:len(shared[k % 3]) - 3 * k] + prose(50 + k, 20)) for k in range(14)]
    return [*EDGES, *rows, (200, shared[0]), (201, shared[1] * 2), (202, "ab" * 500), (203, "ba" * 400)]


@pytest.mark.parametrize("hot, part, shard", [(repeats.HOT, repeats.PART, repeats.SHARD), (2, 700, 2000)])
def test_removal(spark, monkeypatch, hot, part, shard):
    monkeypatch.setattr(repeats, "PART", part)
    monkeypatch.setattr(repeats, "SHARD", shard)
    got = Counter(map(tuple, repeats.removal_report(table(spark, passages()), hot=hot).collect()))
    assert got == plain(passages(), 400)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([b"abc", b"abd", b"x", b"yyyy"]), min_size=1, max_size=40), st.integers(5, 9))
def test_each_window_is_in_one_piece(parts, part):
    text, length, anchor = b"".join(parts), 12, 5
    before, repeats.PART = repeats.PART, part * 10
    try:
        _, low, high, offset, hashes, _ = repeats.find_anchors([text], length, anchor)
    finally:
        repeats.PART = before
    starts = [i for a, b in zip(low, high) for i in range(a, b - length + 1)]
    assert sorted(starts) == list(range(max(0, len(text) - length + 1)))
    selected = {}
    for a, b, o, h in zip(low, high, offset, hashes):
        for i in range(a, b - length + 1):
            assert selected.setdefault(text[i:i + length], (a + o - i, h)) == (a + o - i, h)


def test_anchors_take_little_memory():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 110, 2000, dtype=np.uint8).tobytes() for _ in range(600)]
    texts.append(b"".join(texts))
    tracemalloc.start()
    repeats.find_anchors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20


def test_rows_keep_their_columns(spark):
    rows = passages()
    given_rows = table(spark, rows)
    cut = repeats.remove_repeats(given_rows)
    assert cut.columns == given_rows.columns and cut.count() == len(rows)
    left = {r["spans"]: r["text"] for r in cut.collect()}
    assert left["s9"] == "" and left["s8"] == rows[8][1] and left["s0"] == ""
    assert repeats.remove_repeats(table(spark, [])).collect() == []


@pytest.mark.parametrize("doc_id", [None, 7])
def test_spans_of_repeated_rows_do_not_add_up(spark, doc_id):
    text = prose(80, 400)
    rows = {n: repeats.with_removals(table(spark, [(doc_id, text)] * n).select("doc_id", "text")).collect() for n in (2, 30)}
    spans = {n: {len(r["spans"]) for r in got} for n, got in rows.items()}
    assert len(rows[30]) == 30 and spans[30] == spans[2] and len(spans[2]) == 1
    assert all(repeats.cut(text.encode(), r["spans"])[0] == b"" for r in rows[30])
