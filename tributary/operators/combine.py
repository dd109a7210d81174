"""Every combination of the rows of several small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def every_combination(
    spread: DataFrame, spread_key: str, others: list[DataFrame], buckets: int | None = None
) -> DataFrame:
    """Pair each row of ``spread`` with each combination of rows of ``others``.

    ``spread`` is hashed into ``buckets`` by its key and the other tables are copied into every
    bucket, which makes the pairing an equi-join: the output is built by many tasks, ``spread`` is
    shuffled once for all joins, and nothing is broadcast unless the measured size allows it.

    The output is the whole product: its rows are the product of the row counts of all tables, so
    the grouping columns should have few values. ``buckets`` defaults to four for each core.
    """
    buckets = buckets or max(32, 4 * spread.sparkSession.sparkContext.defaultParallelism)
    every_bucket = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    hashed = spread.withColumn(
        _BUCKET, F.pmod(F.xxhash64(spread_key), F.lit(buckets)).cast("int")
    )
    copies = [other.withColumn(_BUCKET, every_bucket) for other in others]
    return reduce(lambda left, right: left.join(right, _BUCKET), copies, hashed).drop(_BUCKET)
