"""Suffix-array dedup against brute force, by pieces, tries, hot anchors and whole tables."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm import ODD, SMALL, clashing, same
from tributary.llm import suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[k : k + length] for t in data for k in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        gone = gone[: len(t)]
        kept = bytes(b for b, g in zip(t, gone.tolist()) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, kept, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=6), min_size=1, max_size=12), st.booleans())
def test_blind_trie_sorts(strings, alike):
    strings = [b"common beginning" * alike + bytes(b % 3 for b in s) for s in strings]
    order, shared, nodes = suffixes.BlindTrie(strings).walk()
    assert [strings[k] for k in order] == sorted(strings) and len(order) == len(strings)
    pairs = list(zip(order[:-1], order[1:]))
    assert shared == [suffixes._common(strings[a], strings[b]) for a, b in pairs]
    for depth, first, end in nodes:
        assert depth == min(shared[first : end - 1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=8), st.text("ab", max_size=8)), min_size=2, max_size=9), st.integers(1, 10))
def test_repeats_to_both_sides(strings, length):
    before, after = ([s[k].encode() for s in strings] for k in (0, 1))
    expected = []
    for i in range(len(strings)):
        both = [(suffixes._common(before[i], before[j]), suffixes._common(after[i], after[j])) for j in range(len(strings)) if j != i]
        both = [(left, right) for left, right in both if left + right >= length]
        expected.append(tuple(max(x, default=0) for x in zip(*both)) or (0, 0))
    assert suffixes.repeats(before, after, length) == expected


def test_shallow_sort_groups_equal_beginnings():
    text = np.frombuffer(b"abcdefghABCDEFGHxabcdefghABCDEFGHyabcdefghabcdefgh", np.uint8)
    text = np.append(text, np.zeros(16, np.uint8))
    groups = suffixes.shallow(text, np.array([0, 17, 34, 3, 20]), 16)
    assert sorted(sorted(g.tolist()) for g in groups) == [[0, 1]]


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "COMBINE", 3_000)
    monkeypatch.setattr(suffixes, "LEAST_PARTS", 5)


def check(spark, rows, length=suffixes.LENGTH, gram=suffixes.GRAM, parts=4):
    df = spark.createDataFrame(rows, "doc_id long, text string").transform(clashing).repartition(parts)
    got = suffixes.remove_repeated_bytes(df, length=length, gram=gram).collect()
    same([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256) for r in got], [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], length))])
    return got


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    # Null, empty and long texts, rows that repeat, ids with two texts, a third without an id.
    odd = [*enumerate(ODD), (6, ODD[6]), (6, "p" * 199), (None, None), *((None, rows[3][1]) for _ in range(100)), (900, "ab" * 3_000), (901, "é" * 150)]
    got = check(spark, rows + odd)
    assert any(0 < r.n_removed < r.n_bytes for r in got)


def test_edges_of_repeats(spark, small_parts):
    random = np.random.default_rng(8)
    make = lambda n: "".join(random.choice(list("abcdefgh é"), n))
    shared = [make(n) for n in (20, 39, 40, 41, 60, 200)]
    rows = []
    for k in range(60):
        parts = [make(int(random.integers(0, 50)))]
        for _ in range(random.integers(0, 4)):
            s = shared[random.integers(0, len(shared))]
            if random.random() < 0.3:
                at = int(random.integers(0, len(s)))
                s = s[:at] + "X" + s[at + 1 :]
            parts += [s, make(int(random.integers(0, 30)))]
        rows.append((k, "".join(parts)))
    check(spark, rows, length=40, gram=8)


def test_common_line_in_many_texts(spark, small_parts, monkeypatch):
    """Lines of every length round the limit, each in many texts: their anchors are cut finer, twice."""
    monkeypatch.setattr(suffixes, "HOT", 6)
    monkeypatch.setattr(suffixes, "HOT_SHARE", 0)
    random = np.random.default_rng(9)
    make = lambda n: "".join(random.choice(list("abcdefgh"), n))
    lines = [make(n) for n in (30, 38, 39, 40, 47, 90)]
    rows = [(k, make(int(random.integers(0, 60))) + lines[k % 6] + make(int(random.integers(0, 60)))) for k in range(240)]
    steps = []
    keep = suffixes._hot_keys
    monkeypatch.setattr(suffixes, "_hot_keys", lambda *a: steps.append(keep(*a)) or steps[-1])
    check(spark, rows, length=40, gram=8)
    assert [len(hot) for hot in steps] == [2]


def test_empty_table(spark):
    assert suffixes.remove_repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
