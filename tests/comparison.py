"""Compare a Spark result with the expected SQL run by DuckDB on the same files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def differences(actual: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, row count and the multiset of rows are equal."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(actual.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(names)}"]
    order = sorted(names)
    want = Counter(
        tuple(row[names.index(name)] for name in order) for row in expected.fetchall()
    )
    got = Counter(tuple(row) for row in actual.select(order).collect())
    missing, extra = want - got, got - want
    if not missing and not extra:
        return []
    return [
        f"{sum(want.values())} expected, {sum(got.values())} found",
        *(f"missing {row}" for row in list(missing)[:3]),
        *(f"extra   {row}" for row in list(extra)[:3]),
    ]


def types(actual: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Type names that differ between both engines, by column."""
    same = {
        "string": "VARCHAR",
        "double": "DOUBLE",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    found = {name: same.get(dtype, dtype) for name, dtype in actual.dtypes}
    expected = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n}: {found[n]} != {t}" for n, t in expected.items() if found.get(n) != t]
