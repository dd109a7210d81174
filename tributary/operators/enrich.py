"""Left join of a large table to a keyed table, safe against hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

# Hash buckets in which keys are counted: many more than there can be hot ones, few enough for a map
# task to count them in memory whatever the number of keys.
BUCKETS = 1 << 18

# What both sides are joined by.
KEY, PART = "_key", "_part"
MAX_PARTS, MIN_PART_ROWS = 20_000, 1_000_000

_BUCKET = "_bucket"
_ROWS = "_rows"
_PARTS = "_parts"


def _bucket(key: str, kind: DataType) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast(kind)), F.lit(BUCKETS)).cast("int")


def key_type(facts: DataFrame, dimension: DataFrame, key: str) -> DataType:
    """The type both keys are hashed and compared as: equal types as they are, numbers widened."""
    types = [df.select(key).schema[0].dataType for df in (facts, dimension)]
    if types[0] != types[1] and not all(isinstance(t, NumericType) for t in types):
        raise TypeError(f"keys {key} of types {types[0].simpleString()} and {types[1].simpleString()}")
    return facts.select(key).union(dimension.select(key)).schema[0].dataType


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    max_parts: int = MAX_PARTS,
    min_part_rows: int = MIN_PART_ROWS,
) -> DataFrame:
    """``facts`` left join ``dimension`` on ``key``; NULL keys match nothing.

    The key keeps the type it has in ``facts``. Numbers of different types are compared as their
    wider type; other unequal types are refused. A key that ``dimension`` has more than once gives as
    many rows, as in any join.

    Keys, also NULL, are counted by hash bucket, in one pass over the key column. A bucket is hot
    when it has more than ``min_part_rows`` rows and more than 1/``max_parts`` of all rows, so fewer
    than ``max_parts`` buckets are hot whatever the data; two integers for each is all that is
    broadcast. Both limits only say how the work is cut. A hot bucket is cut into parts of that size
    by the map task a row is in. That number is the same when the task is retried, and it also
    spreads exact copies of a row. The dimension rows of the bucket are copied to each of its parts.
    One shuffled join on key and part then gives the whole result. Filters on the facts belong
    before this call: they are not moved below it.
    """
    kind = key_type(facts, dimension, key)
    hot = hot_buckets(facts, key, kind, max_parts, min_part_rows)
    split, copied = in_parts(facts, dimension, key, kind, hot)
    joined = split.join(copied, [KEY, PART], "left").drop(KEY, PART)
    others = [c for c in joined.columns if c != key]
    return joined.select(key, *others)


def hot_buckets(facts: DataFrame, key: str, kind: DataType, max_parts: int, min_part_rows: int) -> DataFrame:
    """Hot buckets of keys and the number of parts of each, fewer than ``max_parts`` rows."""
    counted = facts.groupBy(_bucket(key, kind).alias(_BUCKET)).agg(F.count(F.lit(1)).alias(_ROWS))
    # At most BUCKETS pairs of integers, gathered together with their total.
    gathered = counted.agg(
        F.collect_list(F.struct(_BUCKET, _ROWS)).alias("counts"), F.sum(_ROWS).alias("total")
    )
    parts = F.least(
        F.ceil(F.col(_ROWS) / F.lit(min_part_rows)),
        F.ceil(F.col(_ROWS) * max_parts / F.col("total")),
    )
    return (
        gathered.select("total", F.inline("counts"))
        .select(_BUCKET, parts.cast("int").alias(_PARTS))
        .filter(F.col(_PARTS) > 1)
    )


def in_parts(
    facts: DataFrame, dimension: DataFrame, key: str, kind: DataType, hot: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``KEY`` and ``PART`` to join them by; the dimension without ``key`` itself."""

    def with_parts(df: DataFrame) -> DataFrame:
        found = df.withColumn(_BUCKET, _bucket(key, kind)).join(F.broadcast(hot), _BUCKET, "left")
        keyed = found.withColumn(KEY, F.col(key).cast(kind))
        return keyed.withColumn(_PARTS, F.coalesce(_PARTS, F.lit(1))).drop(_BUCKET)

    own_part = F.pmod(F.spark_partition_id(), F.col(_PARTS))
    every_part = F.explode(F.sequence(F.lit(0), F.col(_PARTS) - 1))
    known = dimension.filter(F.col(key).isNotNull())
    split = with_parts(facts).withColumn(PART, own_part).drop(_PARTS)
    copied = with_parts(known).withColumn(PART, every_part).drop(_PARTS, key)
    return split, copied
