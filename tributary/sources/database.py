"""Snapshot copy of landing tables to bronze."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import BRONZE
from tributary.sources.tables import write_table


def hash_predicates(bucket_expression: str, buckets: int) -> list[str]:
    """One WHERE clause per read task, together covering every row once.

    ``bucket_expression`` is database SQL giving 0..buckets-1, best over all columns so that one hot
    key does not fill one bucket; rows where it is NULL go to the first task.
    """
    rest = [f"({bucket_expression}) = {i}" for i in range(1, buckets)]
    return [f"({bucket_expression}) = 0 OR ({bucket_expression}) IS NULL", *rest]


def jdbc_reader(
    spark: SparkSession,
    url: str,
    predicates: list[str],
    properties: Mapping[str, str],
    fetch_size: int = 10_000,
    query_timeout: int = 7_200,
) -> Callable[[str], DataFrame]:
    """A function from table name to DataFrame, read in parallel by ``predicates``.

    ``fetch_size`` rows come with each round trip; a statement ends after ``query_timeout`` seconds.

    All columns of the landing tables are text, so there is no numeric bound to split on, and one
    connection would pull the whole table through a single task.
    """
    options = {"fetchsize": str(fetch_size), "queryTimeout": str(query_timeout), **properties}
    return lambda table: spark.read.jdbc(url, table, predicates=predicates, properties=options)


def copy_tables(
    read: Callable[[str], DataFrame], bronze: str, tables: Iterable[str] = tuple(BRONZE)
) -> None:
    """Replace each bronze folder by a full copy of the table of the same name, side by side."""

    def copy(table: str) -> None:
        columns = [F.col(f.name).cast("string").alias(f.name) for f in BRONZE[table].fields]
        write_table(read(table).select(columns), bronze, table)

    with ThreadPoolExecutor(len(BRONZE)) as pool:
        list(pool.map(copy, tables))
