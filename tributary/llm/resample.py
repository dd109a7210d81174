"""Importance resampling towards a target: weights from arrays, ranks by parallel sorting by regular sampling.

1. Each task counts hashed features in an array; the sums give one array of gains (log ratio of target and
   corpus). Only these arrays, ``BUCKETS`` long, come to the driver.
2. Each task scores its documents by the array and adds noise from the id (Gumbel top-k draws without
   replacement). It sorts them by score in runs and marks regular samples of each run.
3. Weighted quantiles of the samples are the splitters of the ranges. Runs are cut by them and exchanged,
   the segments of a range merge in one task, and the sizes of the ranges before give exact ranks.

Rows equal in all that is returned travel as one with their number, so a third of all rows without an id
is no hot range.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import Stage
from tributary.llm.tokens import chunks

#: Hash buckets of features, longest feature in words, seed of the noise, words of a document that can be drawn.
BUCKETS, NGRAM, SEED, LEAST = 10_000, 1, 2024, 20
#: Rows sorted together in a task, rows of a range, ranges at least and at most, samples of a range and of a run.
RUN, RANGE, RANGES, SAMPLES, RUN_SAMPLES = 1_000_000, 200_000, (64, 4096), 64, 8
#: Copies of one row written by one step.
COPIES = 4096
#: Words whose bucket a task remembers, and their longest length in bytes.
REMEMBERED, SHORT = 200_000, 40

# Letters A-Z become lower case; of ASCII only digits and letters are in words.
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_MEMBER = -1


class _Buckets(dict):
    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % BUCKETS
        if len(feature) <= SHORT and len(self) < REMEMBERED:
            self[feature] = bucket
        return bucket


def _features(batch: pa.RecordBatch, column: int, ngram: int, known: _Buckets) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows: first, end, words of each row, features of each, buckets of all."""
    for first, end, data, at in chunks(batch.column(column)):
        raw = data.tobytes().translate(_PLAIN)
        words, features, buckets = [], [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            own, before = raw[a:b].split(), len(buckets)
            buckets += map(known.__getitem__, own)
            for n in range(2, ngram + 1):
                buckets += [known[b" ".join(own[k : k + n])] for k in range(len(own) - n + 1)]
            words.append(len(own))
            features.append(len(buckets) - before)
        yield first, end, np.array(words, np.int64), np.array(features, np.int64), np.array(buckets, np.int64)


def _count(ngram: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, members = _Buckets(), np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for _, _, words, _, buckets in _features(batch, 0, ngram, known):
                counts += np.bincount(buckets, minlength=BUCKETS)
                members += int((words >= least).sum())
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, _MEMBER), pa.int32()), pa.array(np.append(counts[some], members), pa.int64())], ["bucket", "n"]
        )

    return run


def _counts(table: DataFrame, text_col: str, ngram: int, least: int) -> tuple[list[int], int]:
    """Features by bucket, and rows with ``least`` words."""
    found = table.select(F.col(text_col).cast("string")).mapInArrow(_count(ngram, least), "bucket int, n long")
    rows = {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # BUCKETS + 1 at most
    return [rows.get(k, 0) for k in range(BUCKETS)], rows.get(_MEMBER, 0)


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, both sides with one more feature in each."""
    size, wanted, n = sum(corpus), sum(target), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (size + n) / ((s + 1) * (wanted + n)))) for s, t in zip(corpus, target)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor(1000 * Gumbel noise), the same for the same id; no id counts as the text ``null``."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_ROW = pa.schema([("id", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])
_SCORED = pa.schema([*_ROW, ("copies", pa.int64()), ("stands_for", pa.int64())])
_SCORED_SQL = "id long, n_features long, weight long, score long, copies long, stands_for long"


def _columns(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    """The columns of _ROW, with a flag for rows without an id."""
    ids = table.column("id")
    null = np.asarray(ids.is_null())
    return [ids.fill_null(0).to_numpy().astype(np.int64), *(table.column(c).to_numpy() for c in _ROW.names[1:]), null]


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """By score from the highest, then id, none last, then the rest."""
    ids, features, weight, score, null = columns
    return np.lexsort((features, weight, ids, null, -score))


def _same_as_before(columns: list[np.ndarray]) -> np.ndarray:
    same = np.zeros(len(columns[0]), bool)
    same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return same


def _score(gain: np.ndarray, ngram: int, least: int, seed: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Scored rows; those that can be drawn in sorted runs. ``share``: samples a row."""

    def sorted_run(parts: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(parts).combine_chunks()
        table = table.take(pa.array(_order(_columns(table))))
        heads = np.flatnonzero(~_same_as_before(_columns(table)))
        copies = np.diff(np.append(heads, table.num_rows))
        table, n = table.take(pa.array(heads)), len(heads)
        stands_for = np.zeros(n, np.int64)
        samples = min(n, max(RUN_SAMPLES, math.ceil(share * n)))
        at = (np.arange(1, samples + 1) * n) // samples - 1
        before = np.concatenate([[0], np.cumsum(copies)])
        stands_for[at] = np.diff(np.concatenate([[0], before[at + 1]]))
        return table.append_column("copies", pa.array(copies, pa.int64())).append_column("stands_for", pa.array(stands_for))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, rows = _Buckets(), [], 0
        for batch in batches:
            for first, end, words, features, buckets in _features(batch, 1, ngram, known):
                total = np.concatenate([[0], np.cumsum(gain[buckets])])
                ends = np.cumsum(features)
                weight = (total[ends] - total[ends - features]) // np.maximum(features, 1)
                ids = batch.column(0).slice(first, end - first).cast(pa.int64())
                score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                table = pa.Table.from_arrays([ids, pa.array(features), pa.array(weight), pa.array(score)], schema=_ROW)
                few = words < least
                rest = table.filter(pa.array(few))
                ones = pa.array(np.zeros(rest.num_rows, np.int64))
                yield from rest.append_column("copies", ones).append_column("stands_for", ones).cast(_SCORED).to_batches()
                held.append(table.filter(pa.array(~few)))
                rows += held[-1].num_rows
                if rows >= RUN:
                    yield from sorted_run(held).cast(_SCORED).to_batches()
                    held, rows = [], 0
        if rows:
            yield from sorted_run(held).cast(_SCORED).to_batches()

    return run


def _splitters(samples: pa.Table, ranges: int) -> list[np.ndarray]:
    """The last row of each range but the last one, as columns: weighted quantiles of the samples."""
    columns = _columns(samples)
    order = _order(columns)
    total = np.cumsum(samples.column("stands_for").to_numpy()[order])
    at = np.unique(np.searchsorted(total, np.arange(1, ranges) * (total[-1] / ranges))) if len(total) else np.zeros(0, int)
    return [c[order][at] for c in columns]


def _cut(splitters: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with the number of their range."""
    n = len(splitters[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [np.concatenate([s, c]) for s, c in zip(splitters, _columns(batch))]
            order = _order(both)  # stable: a splitter stands before rows equal to it
            is_splitter = order < n
            # A splitter is the last row of its range: rows equal to it belong there.
            keys = [c[order] for c in both]
            new = ~_same_as_before(keys)
            before = np.cumsum(is_splitter) - is_splitter
            first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
            part = np.empty(len(order), np.int64)
            part[order] = before[first]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(part[n:], pa.int32())], [*_SCORED.names[:5], "range"])

    return run


_MERGED_SQL = "id long, n_features long, weight long, score long, copies long, range int, before long"


def _merge(table: pa.Table) -> pa.Table:
    """The segments of one range in order, equal rows as one, and how many rows of the range stand before."""
    table = table.combine_chunks()
    table = table.take(pa.array(_order(_columns(table))))
    heads = np.flatnonzero(~_same_as_before(_columns(table)))
    copies = np.add.reduceat(table.column("copies").to_numpy(), heads)
    rows = table.take(pa.array(heads)).set_column(4, "copies", pa.array(copies, pa.int64()))
    return rows.append_column("before", pa.array(np.cumsum(copies) - copies, pa.int64()))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
    percent: int = 10, ngram: int = NGRAM, least: int = LEAST, seed: int = SEED,
) -> DataFrame:
    """Draws ``percent`` of the documents with ``least`` words, those most like the target more likely.

    A row per input row: id, ``n_features``, ``weight`` (mean gain of its features, floored; 0 without any),
    ``score`` (weight and noise) and ``rank`` from 1 for the drawn, null for the others; ties go to
    the smaller id, no id last, then by weight and features; rows equal in all have ranks in a row. Null texts
    are empty. Other columns are not carried along. Without a target all weights follow from the corpus alone;
    an empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession)
    corpus, members = _counts(docs, text_col, ngram, least)
    wanted, _ = _counts(target, target_text, ngram, least)
    ranges = min(max(RANGES[0], members // RANGE), RANGES[1])
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    score = _score(gains(corpus, wanted), ngram, least, seed, SAMPLES * ranges / max(members, 1))
    scored = stage.table(source.mapInArrow(score, _SCORED_SQL), "scored")
    can = scored.where("copies > 0")
    splitters = _splitters(can.where("stands_for > 0").toArrow(), ranges)  # SAMPLES a range and RUN_SAMPLES a run
    parts = can.mapInArrow(_cut(splitters), "id long, n_features long, weight long, score long, copies long, range int")
    merged = stage.table(parts.groupBy("range").applyInArrow(_merge, _MERGED_SQL), "merged")
    sizes = dict(merged.groupBy("range").agg(F.sum("copies")).collect())  # one for each range
    starts, total = [], 0
    for part in range(len(splitters[0]) + 1):
        starts.append((part, total))
        total += sizes.get(part, 0)
    offsets = docs.sparkSession.createDataFrame(starts, "range int, offset long")
    drawn = percent * members // 100
    placed = merged.join(F.broadcast(offsets), "range").withColumn("first", F.col("offset") + F.col("before") + 1)
    some = placed.withColumn("part", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
    every = some.withColumn("k", F.explode(F.expr(f"sequence(part * {COPIES}, least(copies, (part + 1) * {COPIES}) - 1)")))
    names = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    place = F.col("first") + F.col("k")
    ranked = every.select(*names, F.when(place <= drawn, place).alias("rank"))
    return ranked.union(scored.where("copies = 0").select(*names, F.lit(None).cast("long")))
