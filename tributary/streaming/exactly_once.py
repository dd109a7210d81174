"""Landing exactly once in any sink (S3): rows are staged by tasks and count only when a ledger names them.

The sink is a Python data source. Each task stages its rows under names of their own. When all tasks of a batch are
done, one ledger entry names what they staged; until then nobody reads it. A batch that is run again, because the
stream died before its entry or between the entry and Spark's own record, either gets its entry then or finds it there
and drops what it staged the second time. Rows staged by tasks that died stay behind unnamed; ``delete_abandoned``
removes them.

A ledger belongs to the one checkpoint that issues its batch ids: a batch older than the last entry is refused.
"""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator, Mapping
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from tributary.sources.files import exists
from tributary.streaming.envelope import TARGET, landing_rows, table_columns
from tributary.streaming.landing import CADENCE

LEDGER = "_ledger"


class Store(ABC):
    """What a sink has to do. Its methods run in different processes, so it holds settings only."""

    @abstractmethod
    def stage(self, batches: Iterator[pa.RecordBatch]) -> list[str]:
        """Stores the rows of one task where no reader looks, and names what was stored."""

    @abstractmethod
    def last_entry(self) -> int | None:
        """The newest batch in the ledger."""

    @abstractmethod
    def enter(self, batch_id: int, staged: list[str]) -> None:
        """Makes a batch visible, all of it or nothing."""

    @abstractmethod
    def discard(self, staged: list[str]) -> None:
        """Removes staged rows that are no longer wanted, if they are there."""


class FolderStore(Store):
    """Parquet files ``<key>=<value>/<id>.parquet`` and ledger files ``_ledger/batch=<n>`` that name them, line by line.

    ``root`` is any path or address that Arrow's file systems open; the key is a text column without nulls and with few values,
    as each value keeps a file open in a task. An entry is written aside and renamed.
    """

    def __init__(self, root: str, key: str = TARGET) -> None:
        self.root, self.key = root.rstrip("/"), key

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def stage(self, batches: Iterator[pa.RecordBatch]) -> list[str]:
        system, root = self._place()
        part, files = uuid.uuid4().hex, {}
        try:
            with ExitStack() as closing:
                for batch in batches:
                    keys, rows = batch.column(self.key), batch.drop_columns([self.key])
                    for value in pc.unique(keys).to_pylist():
                        if value not in files:
                            system.create_dir(f"{root}/{self.key}={value}", recursive=True)
                            stream = system.open_output_stream(f"{root}/{self.key}={value}/{part}.parquet")
                            files[value] = closing.enter_context(pq.ParquetWriter(closing.enter_context(stream), rows.schema))
                        files[value].write_batch(rows.filter(pc.equal(keys, value)))
        except BaseException:
            self.discard([f"{self.key}={value}/{part}.parquet" for value in files])
            raise
        return [f"{self.key}={value}/{part}.parquet" for value in files]

    def last_entry(self) -> int | None:
        system, root = self._place()
        found = system.get_file_info(fs.FileSelector(f"{root}/{LEDGER}", allow_not_found=True))
        numbers = [int(i.base_name.partition("=")[2]) for i in found if i.base_name.startswith("batch=")]
        return max(numbers, default=None)

    def enter(self, batch_id: int, staged: list[str]) -> None:
        system, root = self._place()
        system.create_dir(f"{root}/{LEDGER}", recursive=True)
        aside = f"{root}/{LEDGER}/.{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            out.write("".join(f"{name}\n" for name in staged).encode())
        system.move(aside, f"{root}/{LEDGER}/batch={batch_id}")

    def discard(self, staged: list[str]) -> None:
        system, root = self._place()
        for name in staged:
            if system.get_file_info(f"{root}/{name}").type != fs.FileType.NotFound:
                system.delete_file(f"{root}/{name}")


@dataclass
class Staged(WriterCommitMessage):
    names: list[str]


class LedgerWriter(DataSourceStreamArrowWriter):
    """Stages in tasks, enters or discards in the driver; ``reached`` is told each step that is done."""

    def __init__(self, store: Store, reached: Callable[[str], None]) -> None:
        self.store, self.reached = store, reached

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        names = self.store.stage(iterator)
        self.reached("staged")
        return Staged(names)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        staged = [name for message in messages if message is not None for name in message.names]
        last = self.store.last_entry()
        if last is not None and batchId < last:
            raise ValueError(f"batch {batchId} after batch {last}: the ledger belongs to another checkpoint")
        self.reached("looked up")
        if batchId == last:
            self.store.discard(staged)
            self.reached("discarded")
        else:
            self.store.enter(batchId, staged)
            self.reached("entered")

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        # Spark also aborts a batch whose commit failed, which may have happened after its entry.
        if self.store.last_entry() != batchId:
            self.store.discard([name for message in messages if message is not None for name in message.names])


def _nothing(step: str) -> None:
    pass


def ledger_sink(spark: SparkSession, store: Store, reached: Callable[[str], None] = _nothing) -> str:
    """Registers a sink for ``writeStream.format``; the name is its own, so streams with other stores may run beside it."""
    sink = f"ledger_{uuid.uuid4().hex}"

    class LedgerSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return sink

        def streamWriter(self, schema: object, overwrite: bool) -> LedgerWriter:
            return LedgerWriter(store, reached)

    spark.dataSource.register(LedgerSink)
    return sink


def start_landing_once(
    events: DataFrame,
    landing: str,
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
    store: Store | None = None,
    reached: Callable[[str], None] = _nothing,
) -> StreamingQuery:
    """Lands events of the four topics in ``store``, by default a ``FolderStore`` under ``landing``, each exactly once."""
    sink = ledger_sink(events.sparkSession, store or FolderStore(landing), reached)
    return (
        landing_rows(events)
        .writeStream.format(sink)
        .option("checkpointLocation", checkpoint or f"{landing}/_checkpoint")
        .trigger(**(trigger or {"processingTime": CADENCE}))
        .start()
    )


def _entered(spark: SparkSession, landing: str) -> list[str]:
    if not exists(spark, f"{landing}/{LEDGER}"):
        return []
    return [row.value for row in spark.read.text(f"{landing}/{LEDGER}").collect()]


def read_landed_once(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """The rows of one landing table, or of the rejects, that the ledger of a ``FolderStore`` names.

    Names of files pass through the driver, as those of any table do when Spark lists it.
    """
    files = [f"{landing}/{name}" for name in _entered(spark, landing) if name.startswith(f"{TARGET}={table}/")]
    schema = ", ".join(f"`{name}` string" for name in table_columns(table))
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def delete_abandoned(spark: SparkSession, landing: str) -> int:
    """Removes staged files that no entry names, and tells how many. Not while the stream runs: its newest have no entry yet."""
    kept = set(_entered(spark, landing))
    system, root = fs.FileSystem.from_uri(landing.rstrip("/"))
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = [i.path.removeprefix(f"{root}/") for i in found if i.path.endswith(".parquet")]
    abandoned = [n for n in names if n.startswith(f"{TARGET}=") and n not in kept]
    FolderStore(landing).discard(abandoned)
    return len(abandoned)
