"""Landing tables copied to bronze by high-water mark (S4, S5): each landed batch once, whatever crashes.

A copy writes what has landed since the last one to a folder ``<table>/upto=<n>`` of each table, n being the last landed
batch in it, and then the ledger entry ``_ledger/upto=<n>``. Bronze is what the ledger names. A copy that dies before
its entry has left folders that nobody reads; the next one removes them and begins again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import BRONZE
from tributary.sources.files import complete_folders, delete_folder, folders

LEDGER, UPTO, BATCH, TARGET = "_ledger", "upto", "batch", "target"


def copy_new_batches(
    spark: SparkSession,
    landing: str,
    bronze: str,
    tables: Iterable[str] = tuple(BRONZE),
    reached: Callable[[str], None] = lambda step: None,
) -> list[int]:
    """Copies the batches that landed since the last copy and returns their ids. One copy runs at a time.

    Only folders of the new batches are read. ``reached`` is told each step that is done, for monitoring.
    """
    done = complete_folders(spark, f"{bronze}/{LEDGER}", UPTO)
    landed = [n for n in complete_folders(spark, landing, BATCH) if n >= 0 and (not done or n > done[-1])]
    for table in tables:
        for n in folders(spark, f"{bronze}/{table}", UPTO):
            if n not in done:
                delete_folder(spark, f"{bronze}/{table}/{UPTO}={n}")
    reached("cleared")
    if not landed:
        return []
    paths = [f"{landing}/{BATCH}={n}" for n in landed]

    def copy(table: str) -> None:
        schema = ", ".join(f"`{f.name}` string" for f in BRONZE[table].fields)
        rows = spark.read.schema(f"{schema}, {TARGET} string").option("basePath", landing).parquet(*paths)
        rows = rows.where(F.col(TARGET) == table).select(BRONZE[table].names)
        rows.write.mode("overwrite").parquet(f"{bronze}/{table}/{UPTO}={landed[-1]}")
        reached(f"copied {table}")

    with ThreadPoolExecutor(len(BRONZE)) as pool:
        list(pool.map(copy, tables))
    entry = spark.createDataFrame([(n,) for n in landed], "batch long").coalesce(1)
    entry.write.mode("overwrite").parquet(f"{bronze}/{LEDGER}/{UPTO}={landed[-1]}")
    reached("entered")
    return landed


def read_copied(spark: SparkSession, bronze: str, table: str) -> DataFrame:
    """The rows of a bronze table that the ledger names."""
    done = complete_folders(spark, f"{bronze}/{LEDGER}", UPTO)
    if not done:
        return spark.createDataFrame([], BRONZE[table])
    return spark.read.schema(BRONZE[table]).parquet(*(f"{bronze}/{table}/{UPTO}={n}" for n in done))
