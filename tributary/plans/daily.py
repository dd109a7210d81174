"""The daily fact kept by day: a batch replaces the days that it touches, and no others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import to_timestamp
from tributary.plans.gold import fact_transaction_daily

PERIOD, NO_PERIOD = "period", "none"


@dataclass(frozen=True)
class DailyFact:
    """``rows/batch=<id>/period=<day>`` has the transactions of each batch, ``fact/period=<day>`` the fact of each day.

    ``by`` is the date pattern of a folder: a day, or ``yyyy-MM`` where a day has too few rows for files of its
    own. What is replaced is then the months touched. Transactions without a time have a folder of their own.
    """

    spark: SparkSession
    root: str
    by: str = "yyyy-MM-dd"

    def _period(self, time: Column) -> Column:
        return F.coalesce(F.date_format(time, self.by), F.lit(NO_PERIOD)).alias(PERIOD)

    def add(self, transactions: DataFrame, batch_id: int) -> None:
        """Adds silver transactions and replaces the fact of their periods. A retried batch replaces its own rows.

        The periods are read from the batch, and of all transactions only folders of those periods are
        read. There are no more of them than days in the calendar, so they may be broadcast.
        """
        own = f"{self.root}/rows/batch={batch_id}"
        timed = transactions.select("*", self._period(to_timestamp(F.col("Transaction_Date"))))
        # The rows of a period meet before they are written, so it is one file, or several if it is large.
        timed.hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(own)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transactions.schema.fields)
        touched = self.spark.read.schema(f"{PERIOD} string").parquet(own).select(PERIOD).distinct()
        rows = self.spark.read.schema(f"{fields}, batch long, {PERIOD} string").parquet(f"{self.root}/rows")
        fact = fact_transaction_daily(rows.join(F.broadcast(touched), PERIOD, "left_semi"))
        writer = fact.select("*", self._period(F.col("transaction_date"))).hint("rebalance", PERIOD).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD).parquet(f"{self.root}/fact")

    def table(self) -> DataFrame:
        """As ``fact_transaction_daily``."""
        columns = "transaction_date date, total_amount_per_day double, transactions_per_day long"
        return self.spark.read.schema(f"{columns}, {PERIOD} string").parquet(f"{self.root}/fact").drop(PERIOD)
