"""Periodic runs of words, by recursive frequency splitting and a scan of lags.

A run is a stretch with smallest period q and at least max(6, 4 * q) words that no neighbouring word
extends. Each of its words so occurs at least 4 times in it. A word that occurs less often within a
segment can be in no run there: it splits the segment, which makes other words rare in turn. This
recurses to stability, all segments of a batch at once; most text is gone by then. What survives is scanned:
4 * q words in a row hold four multiples of q, so for each lag q only every q-th word is looked at, and
four equal ones in a row are extended to both sides. That takes m * log(m) steps for m words.

Documents are independent, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrays import words_of
from tributary.llm.tokens import chunks

#: A run has at least so many words, and so many periods.
LEAST, TIMES = 6, 4
#: Places looked at in one step of the scan.
STEP = 1 << 18

Run = tuple[int, int, int]
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("best", _RUN), ("collapsed", pa.string())])
_SQL = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, best struct<start: long, length: long, period: long>, collapsed string"


def segments(words: np.ndarray, segment: np.ndarray, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches (first, end) of places in which every word occurs ``times`` times or more.

    ``words``: numbers of the words; ``segment``: of their documents, in order.
    """
    place = np.arange(len(words))
    kinds = int(words.max()) + 1 if len(words) else 1
    while len(place):
        _, which, counts = np.unique(segment * kinds + words[place], return_inverse=True, return_counts=True)
        often = counts[which] >= times
        stable = often.all()
        place, segment = place[often], segment[often]
        # A new segment begins after each word that has gone, and with each document.
        begins = np.ones(len(place), bool)
        begins[1:] = (np.diff(place) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(begins) - 1
        long = np.bincount(segment, minlength=1)[segment] >= least if len(segment) else begins
        place, segment = place[long], segment[long]
        if stable:
            break
    cuts = np.flatnonzero(np.diff(segment)) + 1
    return [(int(s[0]), int(s[-1]) + 1) for s in np.split(place, cuts) if len(s)]


def _extent(words: np.ndarray, lag: int, at: int) -> tuple[int, int]:
    """The longest stretch round ``at`` in which words ``lag`` apart are equal."""
    first, end, last = at, at, len(words) - lag
    size = 32
    while first > 0:
        low = max(0, first - size)
        other = np.flatnonzero(words[low:first] != words[low + lag : first + lag])
        if len(other):
            first = low + int(other[-1]) + 1
            break
        first, size = low, 2 * size
    size = 32
    while end < last:
        high = min(last, end + size)
        other = np.flatnonzero(words[end:high] != words[end + lag : high + lag])
        if len(other):
            end += int(other[0])
            break
        end, size = high, 2 * size
    return first, end + lag


def scan(words: np.ndarray) -> list[Run]:
    """Runs (start, length, period) of one segment, in order of period."""
    longest, found, lag = len(words) // TIMES, {}, 1
    while lag <= longest:
        lags = np.arange(lag, min(longest, lag + STEP) + 1)
        looks = (len(words) - 1) // lags - (TIMES - 2)
        lags = lags[: max(1, int(np.searchsorted(np.cumsum(looks), STEP)))]
        looks = looks[: len(lags)]
        lag = int(lags[-1]) + 1
        q = np.repeat(lags, looks)
        at = (np.arange(len(q)) - np.repeat(np.cumsum(looks) - looks, looks)) * q
        for k in range(1, TIMES):
            equal = words[at] == words[at + k * q]
            q, at = q[equal], at[equal]
        for (start, end), period in found.items():
            inside = (q % period == 0) & (at >= start) & (at + (TIMES - 1) * q < end)
            q, at = q[~inside], at[~inside]
        while len(q):
            period = int(q[0])
            start, end = _extent(words, period, int(at[0]))
            enough = end - start >= max(LEAST, TIMES * period)
            if enough:
                found.setdefault((start, end), period)
            # Multiples of the period inside a run give that run again.
            again = (q % period == 0 if enough else q == period) & (at >= start) & (at + (TIMES - 1) * q < end)
            again[0] = True
            q, at = q[~again], at[~again]
    return [(start, end - start, period) for (start, end), period in found.items()]


def _best(runs: list[Run]) -> Run | None:
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, at in chunks(batch.column(1)):
            raw, known = data.tobytes(), {}
            texts = [raw[a:b].split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            counts = np.array([len(t) for t in texts], np.int64)
            words = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(counts.sum()))
            begins = np.cumsum(counts) - counts
            doc = np.repeat(np.arange(len(texts)), counts)
            runs: list[list[Run]] = [[] for _ in texts]
            for a, b in segments(words, doc):
                d = int(doc[a])
                runs[d] += [(a + start - int(begins[d]), length, period) for start, length, period in scan(words[a:b])]
            kept = []
            for text, own in zip(texts, runs):
                own.sort(key=lambda r: (r[0], r[2]))
                gone = np.zeros(len(text), bool)
                for start, length, period in own:
                    gone[start + period : start + length] = True
                kept.append(b" ".join([w for w, g in zip(text, gone.tolist()) if not g] if own else text))
            names = [f.name for f in _RUN]
            as_rows = [[dict(zip(names, r)) for r in own] for own in runs]
            best = [b and dict(zip(names, b)) for b in map(_best, runs)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, end - first).cast(pa.int64()), pa.array(counts), pa.array(as_rows, _SCHEMA.field("runs").type),
                    pa.array(best, _RUN), pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                schema=_SCHEMA,
            )


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: the id, ``n_words``, ``runs`` (array of start, length, period in words, by start,
    then period), ``best`` (greatest length / period, ties by start, then period; null without runs) and
    ``collapsed``: the words that no run holds after its first period, joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Rows are judged each for itself, those that repeat or have no id too. Other
    columns are not carried along. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] = _find
    return source.mapInArrow(run, _SQL).withColumnRenamed("id", id_col)


def runs_text(runs: str = "runs") -> Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text), the text of about every tenth id made periodic from one of its words on.

    h is the unsigned CRC-32 of the id in decimal, g = h div 10. Where h % 10 = 0 each word from a = g % n
    on becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). Texts without words and rows
    without an id stay as they are.
    """
    id_ = F.col(id_col).cast("long")
    rows = docs.select(id_.alias(id_col), F.col(text_col).cast("string").alias("text"), F.crc32(id_.cast("string").cast("binary")).alias("h"))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    words = F.when(chosen, words_of(F.coalesce("text", F.lit(""))))
    rows = rows.select(id_col, "text", words.alias("w"), F.expr("h div 10").alias("g"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return rows.select(F.col(id_col), F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias(text_col))
