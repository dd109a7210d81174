"""Session settings used by the bench, the tests and stand-alone jobs.

Library code never reads these; it runs in whatever session it is given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE sizes the reduce side from measured bytes, splits skewed join partitions and turns a shuffled
# join into a broadcast only after it has measured the small side.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def spark_session(app: str = "tributary", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
