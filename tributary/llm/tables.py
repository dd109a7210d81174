"""Shared folders and staged tables for jobs that read an intermediate result more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.sources import delete_folder, scratch_folder


class Stage:
    """Intermediate tables of one job, under one new folder of the shared checkpoint folder.

    A written table cuts the lineage, survives the loss of executors, and leaves no aggregate below
    a join, so that adaptive execution can split a hot key of either side.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = scratch_folder(spark)
        self.tables: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        self.tables.add(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


    def drop(self, *beginnings: str) -> None:
        """Deletes the tables whose names begin so: they were read for the last time."""
        self._delete({t for t in self.tables if t.startswith(beginnings)})

    def keep(self, *names: str) -> None:
        """Deletes all tables but these."""
        self._delete(self.tables - set(names))

    def _delete(self, names: set[str]) -> None:
        for name in sorted(names):
            delete_folder(self.spark, self.path(name))
        self.tables -= names


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of text in a column: sizes the number of parts, so that a part stays bounded."""
    return df.selectExpr(f"coalesce(sum(octet_length(`{column}`)), 0)").first()[0]


def parts_for(amount: int, per_part: int, least: int = 1) -> int:
    return max(least, -(-amount // per_part))
