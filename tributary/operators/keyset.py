"""Rows whose key may be in a set of keys, by a Bloom filter of bounded size (J3 of few accounts)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits set for each key, and bits of room for each: about one key in fifty passes that should not.
HASHES, BITS_PER_KEY = 4, 8
_WORD, _BITS = "_word", "_bits"


def _positions(key: Column, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(words * 64)) for seed in range(HASHES)]


def filter_words(keys: int, max_bytes: int) -> int:
    """64-bit words of a filter of so many keys, a power of two within ``max_bytes``."""
    words = 1 << max(0, (keys * BITS_PER_KEY // 64).bit_length())
    return min(words, 1 << ((max_bytes // 8).bit_length() - 1))


def may_be_among(facts: DataFrame, keys: DataFrame, key: str, max_bytes: int = 8 << 20) -> DataFrame:
    """Rows of ``facts`` whose ``key`` is in ``keys``, and a few others; rows without a key go.

    Meant before an inner join, to keep most of the rows that it would drop out of its shuffle. ``keys``
    is read twice: it is counted here to size the filter, whose words are then or-ed together map-side
    into one array. ``max_bytes`` bounds that array whatever the data, and every task gets it. A set too large for it
    makes a fuller filter, which lets more rows pass but never loses one. Keys must have the type of the facts' key.
    """
    if facts.schema[key].dataType != keys.schema[key].dataType:
        raise TypeError(f"keys {key} of types {facts.schema[key].dataType} and {keys.schema[key].dataType}")
    known = keys.select(key).filter(F.col(key).isNotNull())
    words = filter_words(known.count(), max_bytes)
    spots = known.select(F.explode(F.array(*_positions(F.col(key), words))).alias("at"))
    bits = spots.select(
        F.shiftright("at", 6).cast("int").alias(_WORD), F.expr("shiftleft(1L, cast(at & 63 as int))").alias(_BITS)
    )
    # Every word is there, those without a bit as zero, so that the array is dense.
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias(_WORD), F.lit(0).cast("long").alias(_BITS))
    merged = bits.unionByName(every).groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS))
    ordered = F.sort_array(F.collect_list(F.struct(_WORD, _BITS)))
    found = merged.agg(F.transform(ordered, lambda w: w[_BITS]).alias("filter")).scalar()
    hit = F.col(key).isNotNull()
    for at in _positions(F.col(key), words):
        word = F.get(found, F.shiftright(at, 6).cast("int"))
        hit = hit & (word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0)
    return facts.filter(hit)
