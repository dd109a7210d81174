"""Table folders of the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.schemas import BRONZE


def read_bronze(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Bronze Parquet with its fixed all-text schema; other columns in the files are ignored."""
    return spark.read.schema(BRONZE[entity]).parquet(f"{root}/{entity}")


def read_table(
    spark: SparkSession,
    root: str,
    name: str,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """A silver or gold table, with the schema its files carry unless one is given."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(f"{root}/{name}")


def write_table(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> None:
    """Replace a table. ``fmt`` may be ``delta`` where that connector is installed."""
    df.write.format(fmt).mode("overwrite").save(f"{root}/{name}")
