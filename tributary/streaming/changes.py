"""The newest row of each key kept current by a stream, and what changed.

The state holds one row for each key, those of a bucket of keys together as an Arrow table: calls of Python and of the
state are one a bucket and not one a key. A micro-batch reads only its own rows and the state of the buckets of their
keys; it emits a change for each key whose newest row is another one now: the row before, if any, and the row after.
Tables that follow from the newest rows can so be maintained by taking back what was replaced
(``tributary.plans.maintain``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DataType, DateType, StructType, TimestampType

from tributary.operators import keep_latest, newest_order

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "batch"
_STATE, _HAD, _OLD, _NEW = "newest_of_bucket", "_had", "_old_", "_new_"
_BUCKET, _ROWS, _CHANGES = "_bucket", "_rows", "_changes"
_NAN, _PLACE, _HELD, _HELD_PLACE = "_nan_", "_place", "_held", "_held_place"
#: Groups of keys by hash. Each has one value of state and one call of Python a micro-batch; fixed for the life of a checkpoint.
BUCKETS = 4096
#: Bytes of rows that a map task cuts down to the newest of each key at once.
PACKED = 32 << 20


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session whose streams keep their state in RocksDB, which keyed state of its own needs."""
    session = spark.newSession()
    session.conf.set(STORE, ROCKS)
    return session


# Times and dates travel to Python as numbers: their order does not depend on a time zone there.


def _as_number(column: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.unix_micros(column)
    return F.unix_date(column) if isinstance(kind, DateType) else column


def _from_number(column: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(column)
    return F.date_from_unix_date(column) if isinstance(kind, DateType) else column


def _newest_places(table: pa.Table, keys: Sequence[str], order: Sequence[str], marks: Mapping[str, str]) -> tuple[pa.Table, pa.Table]:
    """Rows sorted as ``keep_latest`` does, the newest first, equal ones as they came; and for each key the aggregates of columns."""
    by = []
    for k, name in enumerate(order):
        column = table.column(name)
        if pa.types.is_floating(column.type):
            table = table.append_column(f"{_NAN}{k}", pc.fill_null(pc.is_nan(column), False))
            by.append((f"{_NAN}{k}", "descending"))
        by.append((name, "descending"))
    if by:
        table = table.take(pc.sort_indices(table, by, null_placement="at_end"))
    table = table.append_column(_PLACE, pa.array(np.arange(table.num_rows)))
    if _HELD in table.column_names:
        table = table.append_column(_HELD_PLACE, pc.if_else(table.column(_HELD), table.column(_PLACE), None))
    grouped = pa.table([_group_value(table.column(k)) for k in keys] + [table.column(m) for m in marks], [*map(str, range(len(keys))), *marks])
    return table, grouped.group_by(list(map(str, range(len(keys)))), use_threads=False).aggregate(list(marks.items()))


def _group_value(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """Keys that Spark takes as equal are equal: 0.0 and -0.0, and all that are not a number."""
    if not pa.types.is_floating(column.type):
        return column
    return pc.if_else(pc.is_nan(column), pa.scalar(math.nan, column.type), pc.add(column, pa.scalar(0.0, column.type)))


def _newest(table: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """One row a key."""
    names = table.column_names
    placed, first = _newest_places(table, keys, order, {_PLACE: "min"})
    return placed.take(first.column(f"{_PLACE}_min")).select(names)


def _newest_of_batch(keys: Sequence[str], order: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each Arrow batch one row a key, before rows are shuffled: a hot key is cut down by its map tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _newest(pa.Table.from_batches([batch]), keys, order).combine_chunks().to_batches()

    return run


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(rows: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(bytes(rows))) as found:
        return found.read_all()


def _by_bucket(keys: Sequence[str], order: Sequence[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with a bucket as one Arrow table a bucket, the newest of each key in every ``PACKED`` bytes."""

    def pack(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _newest(pa.Table.from_batches(batches), keys, order)
        table = table.take(pc.sort_indices(table, [(_BUCKET, "ascending")])).combine_chunks()
        bucket = table.column(_BUCKET).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        rows = table.drop_columns([_BUCKET]).cast(schema)
        for first in range(0, len(cuts) - 1, 1024):
            spans = list(zip(cuts, cuts[1:]))[first : first + 1024]
            packed = [_packed(rows.slice(lo, hi - lo)) for lo, hi in spans]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[[lo for lo, _ in spans]], pa.int32()), pa.array(packed, pa.binary())], [_BUCKET, _ROWS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACKED:
                yield from pack(held)
                held, size = [], 0
        if held:
            yield from pack(held)

    return run


class _Newest(StatefulProcessor):
    """The newest rows of the keys of a bucket, as one Arrow table; gives one of the changes."""

    def __init__(self, keys: Sequence[str], order: Sequence[str]) -> None:
        self.keys, self.order = keys, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(_STATE, "rows binary")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        own = [_unpacked(row[1]) for row in rows]
        names = own[0].column_names
        found = self.state.get()
        held = _unpacked(found[0]).cast(own[0].schema) if found else own[0].slice(0, 0)
        # Those that are held come first: of equal rows they stay.
        table = pa.concat_tables([held, *own])
        table = table.append_column(_HELD, pa.array(np.arange(table.num_rows) < held.num_rows))
        placed, first = _newest_places(table, self.keys, self.order, {_PLACE: "min", _HELD_PLACE: "min"})
        now, before = first.column(f"{_PLACE}_min"), first.column(f"{_HELD_PLACE}_min")
        changed = pc.invert(pc.fill_null(pc.equal(now, before), False))
        if not pc.any(changed).as_py():
            return
        self.state.update((_packed(placed.take(now).select(names)),))
        new = placed.take(now.filter(changed)).select(names)
        old = placed.take(before.filter(changed)).select(names)
        columns = [pc.is_valid(before.filter(changed)), *old.columns, *new.columns]
        yield Row(**{_CHANGES: _packed(pa.table(columns, [_HAD, *(f"{side}{n}" for side in (_OLD, _NEW) for n in names)]))})

    def close(self) -> None:
        pass


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of packed tables."""
    for batch in batches:
        for rows in batch.column(0):
            yield from _unpacked(rows.as_py()).combine_chunks().to_batches(max_chunksize=10_000)


def latest_changes(rows: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """A stream of ``(old, new)`` for each key whose newest row changes; ``old`` is NULL for a new key.

    The newest row is that of ``keep_latest`` with the same arguments over all rows so far, also when
    they arrive late or more than once; rows with a NULL key are one group. A key is written once a
    micro-batch however many of its rows that holds. The session must be one of ``stateful_session``.
    """
    names, kinds = rows.columns, [f.dataType for f in rows.schema.fields]
    plain = rows.select([_as_number(F.col(n), t).alias(n) for n, t in zip(names, kinds)])
    by = newest_order(rows, keys, newest_by)
    schema = to_arrow_schema(plain.schema)
    bucketed = plain.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int"))
    own = bucketed.mapInArrow(_by_bucket(keys, by, schema), f"{_BUCKET} int, {_ROWS} binary")
    packed = own.groupBy(_BUCKET).transformWithState(_Newest(keys, by), f"{_CHANGES} binary", "Update", "None")
    columns = [f"`{side}{f.name}` {f.dataType.simpleString()}" for side in (_OLD, _NEW) for f in plain.schema.fields]
    found = packed.mapInArrow(_rows_of, ", ".join([f"{_HAD} boolean", *columns]))

    def row(side: str) -> Column:
        return F.struct([_from_number(F.col(f"{side}{n}"), t).alias(n) for n, t in zip(names, kinds)])

    return found.select(F.when(F.col(_HAD), row(_OLD)).alias("old"), row(_NEW).alias("new"))


def start_changes(
    changes: DataFrame,
    root: str,
    trigger: Mapping[str, object] | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Writes each batch of changes as folder ``changes/batch=<id>`` under ``root``; a retried one replaces its own.

    ``after`` is called with the written changes and the id of the batch, before the batch counts as done.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        path = f"{root}/changes/{BATCH}={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if after:
            after(batch.sparkSession.read.schema(batch.schema).parquet(path), batch_id)

    stream = changes.writeStream.outputMode("update").foreachBatch(land)
    return stream.option("checkpointLocation", f"{root}/_checkpoint").trigger(**(trigger or {"processingTime": "10 minutes"})).start()


def read_changes(spark: SparkSession, root: str, row: StructType) -> DataFrame:
    """All changes so far as ``(old, new, batch)``."""
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in row.fields)
    return spark.read.schema(f"old struct<{fields}>, new struct<{fields}>, {BATCH} long").parquet(f"{root}/changes")


def current_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key: the last change of the key has it."""
    flat = changes.select("new.*", F.col(BATCH).alias("_batch"))
    return keep_latest(flat, keys, ["_batch"]).drop("_batch")
