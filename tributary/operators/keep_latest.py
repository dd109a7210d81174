"""One row per key, the newest one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"


def newest_order(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> list[str]:
    """Columns by which rows of a key are compared: ``newest_by``, then all others but the keys."""
    taken = {name.lower() for name in [*keys, *newest_by]}
    return [*newest_by, *(name for name in df.columns if name.lower() not in taken)]


def keep_latest(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``keys``; all rows with a NULL key form one group.

    The survivor is the row with the greatest ``newest_by`` columns, NULLs last. Ties go to the
    greatest remaining columns in schema order, so the survivor does not depend on how the rows were
    partitioned and a retried task picks the same one.

    Spark turns ``row_number = 1`` into a group limit on both sides of the shuffle: each map task
    sends at most one row per key, so a key that holds a third of the table is cut down before it
    travels.
    """
    newest_first = [F.col(name).desc_nulls_last() for name in newest_order(df, keys, newest_by)]
    if not newest_first:  # nothing but the key: plain distinct
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
    )
