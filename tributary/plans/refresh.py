"""The full refresh: bronze tables to silver tables to the sixteen gold tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from tributary.plans import gold
from tributary.plans.silver import SILVER_TABLES
from tributary.schemas import SILVER
from tributary.sources.tables import read_bronze, read_table, write_table

FLAGS = "table string, column string, malformed long"
Tables = Callable[[DataFrame], dict[str, DataFrame]]

GOLD_TABLES = (
    "dim_customer",
    "dim_account",
    "dim_branch",
    "dim_transaction",
    "dim_account_transaction_type",
    "currency_balance",
    "status_counts",
    "avg_balance_type",
    "daily_openings",
    "fact_account_metrics",
    "fact_branch_country",
    "fact_branch_city",
    "fact_transaction_account",
    "fact_transaction_type",
    "fact_transaction_currency",
    "fact_transaction_daily",
)


@dataclass(frozen=True)
class Lakehouse:
    """Folders of the three layers, the gold format, and the clocks (now when not given).

    ``dedup`` names the entities, of customers and transactions, whose repeated ids are reduced to
    the newest row in silver; accounts and branches always are.
    """

    spark: SparkSession
    bronze: str
    silver: str
    gold: str
    fmt: str = "parquet"
    as_of: date | None = None
    loaded_at: datetime | None = None
    dedup: tuple[str, ...] = ()

    @property
    def staging(self) -> str:
        """Subtotals of the running refresh; the next one overwrites them."""
        return f"{self.gold}/_staging"

    def refresh_silver(self, entity: str) -> DataFrame:
        options = {"dedup": True} if entity in self.dedup else {}
        found = Observation(entity)
        rows = SILVER_TABLES[entity](read_bronze(self.spark, self.bronze, entity), flags=found, **options)
        write_table(rows, self.silver, entity)
        # Counted while the table was written, so nothing is read again.
        counts = [(entity, column, n) for column, n in found.get.items()]
        write_table(self.spark.createDataFrame(counts, FLAGS).coalesce(1), f"{self.silver}/_flags", entity)
        return read_table(self.spark, self.silver, entity, schema=SILVER[entity])

    def flags(self) -> DataFrame:
        """Text of each silver table that had no readable value and became NULL in the last refresh."""
        return self.spark.read.schema(FLAGS).parquet(*(f"{self.silver}/_flags/{e}" for e in SILVER_TABLES))

    def save(self, name: str, df: DataFrame) -> None:
        write_table(df, self.gold, name, self.fmt)

    def saved(self, name: str) -> DataFrame:
        return read_table(self.spark, self.gold, name, self.fmt)


def side_by_side(*steps: Callable[[], object]) -> None:
    """Submit the jobs of independent steps together; the first failure is raised.

    The tail of one job then leaves its executors to the next instead of idling them.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def refresh_customers(lake: Lakehouse) -> None:
    customers = lake.refresh_silver("customers")
    lake.save("dim_customer", gold.dim_customer(customers, lake.loaded_at))


def refresh_accounts(lake: Lakehouse) -> None:
    accounts = lake.refresh_silver("accounts")

    def facts() -> None:
        side_by_side(
            *(partial(lake.save, name, fact(accounts)) for name, fact in gold.ACCOUNT_FACTS.items())
        )
        saved = {name: lake.saved(name) for name in gold.ACCOUNT_FACTS}
        lake.save("fact_account_metrics", gold.account_metrics(saved))

    side_by_side(partial(lake.save, "dim_account", gold.dim_account(accounts)), facts)


def refresh_branches(lake: Lakehouse) -> None:
    branches = lake.refresh_silver("branches")
    side_by_side(
        partial(lake.save, "dim_branch", gold.dim_branch(branches)),
        partial(lake.save, "fact_branch_country", gold.fact_branch_country(branches, lake.as_of)),
        partial(lake.save, "fact_branch_city", gold.fact_branch_city(branches)),
    )


def refresh_transactions(lake: Lakehouse) -> None:
    """Six tables from three passes over the transactions, two of them by way of subtotals."""
    transactions = lake.refresh_silver("transactions")

    def by_way_of(name: str, subtotals: DataFrame, tables: Tables) -> None:
        write_table(subtotals, lake.staging, name)
        written = tables(read_table(lake.spark, lake.staging, name))
        side_by_side(*(partial(lake.save, *table) for table in written.items()))

    side_by_side(
        partial(lake.save, "dim_transaction", gold.dim_transaction(transactions)),
        partial(
            by_way_of, "by_account", gold.account_subtotals(transactions), gold.account_tables
        ),
        partial(by_way_of, "by_day", gold.daily_subtotals(transactions), gold.daily_tables),
    )


ENTITIES = (refresh_transactions, refresh_accounts, refresh_customers, refresh_branches)


def run_all(lake: Lakehouse) -> None:
    """Refresh every table.

    The four entities share nothing until the star join. Each table starts from tables on disk, so a
    lost executor costs a few tasks of one table. Parquet tables are replaced in place: readers may
    miss one while it is written, unless ``fmt`` is a table format with atomic overwrite.
    """
    side_by_side(*(partial(refresh, lake) for refresh in ENTITIES))
