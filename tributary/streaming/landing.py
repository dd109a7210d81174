"""The landing stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.schemas import BRONZE, REJECTS, TOPICS
from tributary.streaming.envelope import (
    LANDING_COLUMNS,
    TARGET,
    landing_columns,
    landing_rows,
    table_columns,
)

CADENCE = "10 minutes"

Sink = Callable[[DataFrame, int], None]


def event_stream(spark: SparkSession, servers: str, **options: str) -> DataFrame:
    """The four topics from their beginning as ``(topic, body)``; needs the Kafka connector.

    A topic partition with more than ``maxRecordsPerPartition`` records is read by several tasks.
    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch when there is a backlog.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(TOPICS))
        .option("startingOffsets", "earliest")
        .option("maxRecordsPerPartition", "1000000")
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string").alias("body"))
    )


def folder_sink(landing: str) -> Sink:
    """S3: each batch as folder ``batch=<id>/target=<table>``, written by one job.

    A batch that is retried after a failure replaces its own folder, so no event lands twice.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        # One open file per target and task, so rows need no sort by target before the write. The
        # session of a batch belongs to this stream alone.
        batch.sparkSession.conf.set(
            "spark.sql.maxConcurrentOutputFileWriters", str(len(TOPICS) + 1)
        )
        landing_rows(batch).write.mode("overwrite").partitionBy(TARGET).parquet(
            f"{landing}/batch={batch_id}"
        )

    return land


def database_sink(url: str, properties: Mapping[str, str], batch_column: str | None = "landed_batch") -> Sink:
    """S3: append to database tables of the same names, and to ``rejects``.

    The source is read once for all five tables. Each row carries its batch in ``batch_column``, which should be indexed.
    A batch that is run again appends only the rows that the failed attempt had not: an append commits task by task, so what
    is there is a part of the batch, and the rest of it is the difference of the two with repeats counted. This needs a
    database that gives text back as it was stored. A task that dies between its commit and its report to Spark may still
    land twice; ``start_landing_once`` has no such gap. Without a batch column (``None``) a batch run again lands twice.
    """

    created = set()

    def land(batch: DataFrame, batch_id: int) -> None:
        rows = landing_rows(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for table in [*BRONZE, REJECTS]:
                own = landing_columns(rows.filter(F.col(TARGET) == table), table)
                if batch_column:
                    own = own.withColumn(batch_column, F.lit(batch_id).cast("long"))
                    if table not in created:
                        # Appending no rows makes the table if it is missing, so that it can be read.
                        own.limit(0).write.jdbc(url, table, mode="append", properties=dict(properties))
                        created.add(table)
                    landed = _landed_of(batch.sparkSession, url, table, batch_column, batch_id, properties)
                    if landed is not None:
                        own = own.exceptAll(landed.select([F.col(c).cast(t) for c, t in own.dtypes]))
                own.write.jdbc(url, table, mode="append", properties=dict(properties))
        finally:
            rows.unpersist()

    return land


def _landed_of(
    spark: SparkSession, url: str, table: str, batch_column: str, batch_id: int, properties: Mapping[str, str]
) -> DataFrame | None:
    """What a failed attempt at this batch has left; usually nothing, so that the batch needs no shuffle."""
    landed = spark.read.jdbc(url, table, properties=dict(properties)).filter(F.col(batch_column) == batch_id)
    return None if landed.isEmpty() else landed


def create_landing(spark: SparkSession, landing: str) -> None:
    """The landing tables, empty, where there are none yet, so that they can be read at once."""
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["topic", *LANDING_COLUMNS]))
    empty.write.mode("overwrite").parquet(f"{landing}/batch=-1/{TARGET}=customers")


def start_landing(
    events: DataFrame,
    landing: str,
    checkpoint: str | None = None,
    trigger: Mapping[str, object] | None = None,
    sink: Sink | None = None,
) -> StreamingQuery:
    """Append events to the landing tables, by default as folders under ``landing``.

    Each micro-batch is read and classified once. The checkpoint sits inside ``landing`` unless
    given: batch ids only mean something together with the checkpoint that issued them.

    Without a sink of its own the landing tables exist from the start.

    ``trigger`` defaults to every ten minutes; use ``{"availableNow": True}`` to drain and stop.
    """
    if sink is None:
        create_landing(events.sparkSession, landing)
    return (
        events.writeStream.foreachBatch(sink or folder_sink(landing))
        .option("checkpointLocation", checkpoint or f"{landing}/_checkpoint")
        .trigger(**(trigger or {"processingTime": CADENCE}))
        .start()
    )


def read_landing(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """One landing table with exactly its own columns, or the rejects with their topic."""
    columns = [*table_columns(table), "batch", TARGET]
    schema = ", ".join(f"{name} {'long' if name == 'batch' else 'string'}" for name in columns)
    rows = spark.read.schema(schema).parquet(landing).filter(F.col(TARGET) == table)
    return rows.select(table_columns(table))
