"""Parquet files carried inside messages."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

RAW = "raw_data"
ROWS_PER_BATCH = 10_000


def payload_schema(columns: list[str]) -> StructType:
    fields = [StructField(name, StringType(), True) for name in columns]
    return StructType([*fields, StructField(RAW, BinaryType(), True)])


def explode_parquet_payloads(df: DataFrame, payload: str, columns: list[str]) -> DataFrame:
    """One row per row of each Parquet payload, every value as text.

    A missing column is NULL. A payload that is not Parquet, or whose columns are not all among
    ``columns``, is kept as one row with its bytes in ``raw_data``. A payload is no larger than a
    message of the event hub, and its rows leave in batches.
    """
    schema = payload_schema(columns)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field(name, pa.string()) for name in columns] + [pa.field(RAW, pa.binary())]
        target = pa.schema(fields)
        for batch in batches:
            for message in batch.column(0):
                if message.is_valid:
                    yield from _rows_of(message.as_py(), columns, target)

    return df.select(payload).mapInArrow(explode, schema)


def _rows_of(message: bytes, columns: list[str], target: pa.Schema) -> list[pa.RecordBatch]:
    """Decoded whole before anything is emitted, so a payload broken half-way emits none of its rows."""
    try:
        return list(_text_batches(message, columns, target))
    except (pa.ArrowException, OSError, KeyError):
        empty = [pa.nulls(1, pa.string()) for _ in columns]
        raw = [*empty, pa.array([message], pa.binary())]
        return [pa.RecordBatch.from_arrays(raw, schema=target)]


def _text_batches(
    message: bytes, columns: list[str], target: pa.Schema
) -> Iterator[pa.RecordBatch]:
    file = pq.ParquetFile(io.BytesIO(message))
    present = set(file.schema_arrow.names)
    if not present <= set(columns):
        raise KeyError("payload has columns the table lacks")
    for batch in file.iter_batches(ROWS_PER_BATCH):
        values = [
            pc.cast(batch.column(name), pa.string())
            if name in present
            else pa.nulls(batch.num_rows, pa.string())
            for name in columns
        ]
        no_raw = pa.nulls(batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([*values, no_raw], schema=target)
