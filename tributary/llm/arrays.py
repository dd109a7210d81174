"""Array expressions that several operators share. All are built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A gap between words, as a Java pattern.
GAP = r"[\x20\x09-\x0D]+"
_BLOCK = 128


def words_of(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D."""
    return F.array_remove(F.split(text, GAP, -1), "")


def starts_of(lengths: str) -> Column:
    """Running sum of the lengths before each, for an array<int> column; sums by blocks of 128."""
    block = f"aggregate(slice({lengths}, b * {_BLOCK} + 1, {_BLOCK}), 0, (s, x) -> s + x)"
    sums = f"transform(sequence(0, int(size({lengths}) div {_BLOCK})), b -> {block})"
    before = f"aggregate({sums}, array(0), (s, x) -> array_append(s, element_at(s, -1) + x))"
    within = f"aggregate(slice({lengths}, int(i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK}), 0, (s, y) -> s + y)"
    return F.expr(
        f"element_at(transform(array({before}), p -> transform({lengths}, (x, i) -> p[int(i div {_BLOCK})] + {within})), 1)"
    )


def with_matches(df: DataFrame, name: str, text: str, gate: Column, pattern: str) -> DataFrame:
    """Adds array column ``name`` of (start, match): all matches of a Java pattern in column ``text``.

    Spark has no function for the places of matches, so the text is split at the pattern and the
    lengths of gaps and matches are summed up. Where ``gate`` is false there are none.
    """
    none = F.expr("cast(array() as array<string>)")
    m, g, n, s = (f"{name}_{x}" for x in "mgns")
    df = df.withColumn(m, F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(g, F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none))
    df = df.withColumn(n, F.expr(f"transform({m}, (x, i) -> length({g}[i]) + length(x))"))
    df = df.withColumn(s, F.when(F.size(m) > 0, starts_of(n)).otherwise(F.expr("cast(array() as array<int>)")))
    made = F.expr(f"transform({m}, (x, i) -> named_struct('start', {s}[i] + length({g}[i]), 'match', x))")
    return df.withColumn(name, made).drop(m, g, n, s)


def settled(df: DataFrame) -> DataFrame:
    """The same rows behind a generator, below which the optimizer moves no filter.

    Moved below, a filter on a computed column takes a second copy of the computation along, and
    with arrays that build on one another a copy for each element.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode_outer(F.array(row)).alias("row")).select("row.*")
