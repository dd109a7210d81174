"""Words and rolling hashes of whole Arrow batches, in numpy.

A word is a run of bytes other than space and the controls 0x09-0x0D, which in UTF-8 is the same as
``[^\\x20\\x09-\\x0D]+`` on characters. Hashes are 64 bits: a polynomial over random byte values,
then a mixing step. Two different words share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; numpy needs about 40 times that.
CHUNK = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 3
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240607)
_VALUE = _RNG.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _VALUE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse, self.size = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.up, self.down = self._powers(self.base), self._powers(self.inverse)
        return self.up[:n], self.down[:n]

    def _powers(self, base: int) -> np.ndarray:
        factors = np.full(self.size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


_BYTES, _WORDS = _Powers(_BASE), _Powers(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit changes about half the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """The words of some documents, in order. ``first[d]:first[d + 1]`` are those of document d."""

    hashes: np.ndarray
    first: np.ndarray
    #: Where words begin and end in the bytes, and the running polynomial of the bytes.
    starts: np.ndarray
    ends: np.ndarray
    total: np.ndarray

    def heads(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first ``size`` bytes of the words that are longer, and which words those are."""
        long = np.flatnonzero(self.ends - self.starts > size)
        at = self.starts[long]
        down = _BYTES.upto(len(self.total))[1]
        return mix((self.total[at + size] - self.total[at]) * down[at] + np.uint64(size)), long

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rabin-Karp hash, document and start of every run of n words inside a document."""
        starts = np.maximum(self.counts - n + 1, 0)
        doc = np.repeat(np.arange(len(starts)), starts)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts)
        return self._runs(self.first[doc] + place, n), doc, place

    def whole(self, docs: np.ndarray) -> np.ndarray:
        """Hash of the whole word sequence of the given documents."""
        return self._runs(self.first[docs], self.counts[docs])

    def _runs(self, at: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        up, down = _WORDS.upto(len(self.hashes) + 1)
        total = np.zeros(len(self.hashes) + 1, np.uint64)
        np.cumsum(self.hashes * up[:-1], out=total[1:])
        return mix((total[at + n] - total[at]) * down[at])


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False, gap: np.ndarray = _GAP) -> Words:
    """``data``: bytes of all texts in a row; ``offsets``: where each begins, and the
    end; ``gap``: the bytes that are between words."""
    ends_word, gap = gap, np.ones(len(data) + 1, bool)
    gap[:-1] = ends_word[data]
    before = np.ones(len(data) + 1, bool)
    before[1:] = gap[:-1]
    before[offsets] = True  # a text ends the word of the text before it
    starts = np.flatnonzero(before & ~gap)
    after = np.zeros(len(data) + 1, bool)
    after[offsets] = True
    after |= gap
    ends = np.flatnonzero(after[1:] & ~gap[:-1]) + 1
    up, down = _BYTES.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _VALUE)[data] * up[:-1], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, total)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        at = np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes (or one longer row): first, end, bytes, offsets."""
    data, at = texts_of(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        end = min(end, n)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end
