"""Periodic runs and importance resampling against brute force, with nulls, ties, repeated and very long rows."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm import ODD, SMALL, clashing, same, words
from tributary.llm import resample, runs
from tributary.llm.queries import QUERIES


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(w, found):
    gone = {p for s, n, q in found for p in range(s + q, s + n)}
    return " ".join(x for p, x in enumerate(w) if p not in gone)


def brute_best(found):
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def runs_of(w):
    ids = np.array([sorted(set(w)).index(x) for x in w], np.int64)
    out = [(a + s, n, q) for a, b in runs.segments(ids, np.zeros(len(w), np.int64)) for s, n, q in runs.scan(ids[a:b])]
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=5), st.integers(1, 9)), max_size=8), st.text("abcd", max_size=12))
def test_runs_of_powers(blocks, tail):
    w = list("".join(block * times for block, times in blocks) + tail)
    assert runs_of(w) == brute_runs(w)


def test_runs_of_long_texts_take_several_steps(monkeypatch):
    monkeypatch.setattr(runs, "STEP", 64)
    random = np.random.default_rng(4)
    for _ in range(30):
        period = random.integers(1, 60)
        w = [*random.integers(0, 5, random.integers(0, 80)), *np.tile(random.integers(0, 3, period), random.integers(3, 7)), *random.integers(0, 5, 40)]
        assert runs_of(w) == brute_runs(w)
    assert runs_of(["a"] * 30_000) == [(0, 30_000, 1)]


def test_frequency_splitting_recurses():
    """x is often enough in the whole, but not between the words that split first."""
    w = np.array([0, 0, 0, 0, 0, 0, 1, 9, 1, 0, 0, 1, 0, 0, 0, 0, 8, 1, 0, 0, 0, 0, 0, 0])
    assert runs.segments(w, np.zeros(len(w), np.int64)) == [(0, 6), (18, 24)]


def test_find_runs(spark):
    period = " ".join(f"w{k}" for k in range(40))
    texts = [*ODD, period + (" " + period) * 5 + " w0 w1", "a a a a a", "a a a a a a", "a b " * 5 + "a", "x " + "p q r " * 4 + "y " + "p q r " * 5, "z " * 200_000]
    rows = [*enumerate(texts), (3, texts[-2]), (None, texts[-2]), (None, None), (3, texts[-2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").transform(clashing).repartition(3)
    expected = []
    for doc_id, text in rows:
        w = words(text)
        found = brute_runs(w) if len(set(w)) > 1 or len(w) < 100 else [(0, len(w), 1)] * (len(w) > 5)
        expected.append((doc_id, len(w), found, brute_best(found), brute_collapsed(w, found)))
    got = runs.find_runs(df).collect()
    same([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.best and tuple(r.best), r.collapsed) for r in got], expected)
    assert runs.find_runs(df.limit(0)).count() == 0


def test_planted_runs_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in rows:
        w, h = words(text), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i if i < a else a + (i - a) % p] for i in range(len(w))]
        found = brute_runs(w)
        best = brute_best(found) or (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, brute_collapsed(w, found))]
        expected.append((doc_id, len(found), *best, milli, *sha))
    same([tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()], expected)
    assert sum(e[1] > 0 for e in expected) >= 10
    odd = spark.createDataFrame([(None, "a b c"), (20, None), (20, " ")], "doc_id long, text string")
    same([tuple(r) for r in runs.with_planted_runs(odd).collect()], [(None, "a b c"), (20, None), (20, " ")])


def brute_resample(docs, target, percent, ngram, least):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return w, [" ".join(w[k : k + n]) for n in range(1, ngram + 1) for k in range(len(w) - n + 1)]

    bucket = lambda x: zlib.crc32(x.encode()) % 10_000
    s = collections.Counter(bucket(x) for _, text in docs for x in features(text)[1])
    t = collections.Counter(bucket(x) for text in target for x in features(text)[1])
    gain = {k: math.floor(1000 * math.log((t[k] + 1) * (s.total() + 10_000) / ((s[k] + 1) * (t.total() + 10_000)))) for k in s}
    rows, can = [], []
    for doc_id, text in docs:
        w, f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        (can if len(w) >= least else rows).append((doc_id, len(f), weight, score))
    can.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    return [(*r, None) for r in rows] + [(*r, k + 1 if k < percent * len(can) // 100 else None) for k, r in enumerate(can)]


def test_resample(spark, monkeypatch):
    monkeypatch.setattr(resample, "RANGES", (7, 9))
    monkeypatch.setattr(resample, "RUN", 50)
    monkeypatch.setattr(resample, "RUN_SAMPLES", 2)
    monkeypatch.setattr(resample, "SAMPLES", 3)
    monkeypatch.setattr(resample, "COPIES", 4)
    some = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    long = " ".join(f"Ab{k % 17}\x7fÉ-{k % 5}" for k in range(60))
    # A third of all rows are equal and have no id; one id has several texts, and a text twice.
    rows = [*some, *((1000 + k, t) for k, t in enumerate(ODD)), *((None, long) for _ in range(120)), (7, long), (7, long), (7, long + " x"), (None, None), (5000, "b " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").transform(clashing).repartition(6)
    items = ["Ab1 é and the w1", None, "", "w2 w3 " * 20]
    target = spark.createDataFrame([(t,) for t in items], "text string").transform(clashing)
    for percent, ngram, least in ((10, 1, 20), (100, 2, 3)):
        got = resample.resample(df, target, percent=percent, ngram=ngram, least=least).collect()
        same([tuple(r) for r in got], brute_resample(rows, items, percent, ngram, least))


def test_resample_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, some).count() == resample.resample(none, none).count() == 0
    same([tuple(r) for r in resample.resample(some, none).collect()], brute_resample([(1, "a b"), (2, None)], [], 10, 1, 20))


def test_ranges_are_even(spark):
    """Regular samples of runs of unlike length bound every range."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 25), k -> concat('w', (id * k) % 97)))").alias("text")).repartition(4)

    corpus, members = resample._counts(df, "text", 1, 20)
    found: list[int] = []
    source = df.select(F.col("doc_id").alias("id"), "text")
    ranges = 64
    scored = source.mapInArrow(resample._score(resample.gains(corpus, corpus), 1, 20, 1, resample.SAMPLES * ranges / members), resample._SCORED_SQL)
    table = scored.toArrow()
    splitters = resample._splitters(table.filter(np.asarray(table.column("stands_for")) > 0), ranges)
    for batch in resample._cut(splitters)(iter(table.to_batches())):
        found += batch.column("range").to_pylist()
    sizes = collections.Counter(found)
    assert members == 20_000 and len(sizes) == ranges and max(sizes.values()) <= 2 * members / ranges
