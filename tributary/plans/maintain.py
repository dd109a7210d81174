"""Facts maintained from changes instead of recomputed.

A change takes back the row that was replaced and adds its successor: measures are summed with the sign of
the row. Each batch writes its signed subtotals; a table is their sum. Sums of doubles are kept as sums
of exact parts (``tributary.functions.exact``), so what is taken back leaves nothing behind, and the
result does not depend on how updates arrived.

A batch reads its own changes and nothing else. ``Maintained.compact`` folds the subtotals of many
batches into one folder.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import PARTS, age_in_days, country_or_unknown, exact_parts, exact_total, parse_date, to_timestamp, trimmed
from tributary.plans.refresh import side_by_side
from tributary.sources.files import complete_folders, delete_folder

ROWS = "rows"


@dataclass(frozen=True)
class Fact:
    """A table grouped by ``keys``: expressions of a row by name. ``sums`` are of doubles, exact; ``counts`` of
    rows where the expression is not NULL; ``table`` makes the columns from those measures."""

    keys: Mapping[str, Column]
    table: Mapping[str, Column]
    sums: Mapping[str, Column] = field(default_factory=dict)
    counts: Mapping[str, Column] = field(default_factory=dict)

    def deltas(self, changes: DataFrame) -> DataFrame:
        """Signed subtotals of ``(old, new)`` changes; groups in which nothing changed are left out."""
        taken = F.when(F.col("old").isNotNull(), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
        added = F.struct(F.lit(1).alias("sign"), F.col("new").alias("row"))
        signed = changes.select(F.explode(F.array_compact(F.array(taken, added))).alias("c")).select("c.sign", "c.row.*")
        return self.subtotals(signed)

    def subtotals(self, signed: DataFrame) -> DataFrame:
        """Subtotals of rows with a ``sign``."""
        sign = F.col("sign")
        parts = {name: exact_parts(value.cast("double")) for name, value in self.sums.items()}
        cut = signed.select(
            "sign", *(value.alias(name) for name, value in self.keys.items()), *(F.struct(p).alias(name) for name, p in parts.items()),
            *(value.isNotNull().cast("int").alias(name) for name, value in self.counts.items()),
        )
        measures = [F.sum(sign * F.col(name)).alias(name) for name in self.counts]
        sums = [F.sum(sign * F.col(f"{name}.{x}")).alias(f"{name}_{x}") for name in self.sums for x in PARTS]
        return cut.groupBy(*self.keys).agg(F.sum(sign).cast("long").alias(ROWS), *measures, *sums)

    def added(self, subtotals: DataFrame) -> DataFrame:
        """Subtotals with one row a group."""
        measures = [c for c in subtotals.columns if c not in self.keys]
        types = dict(subtotals.dtypes)
        return subtotals.groupBy(*self.keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in measures])

    def live(self, subtotals: DataFrame) -> DataFrame:
        """Subtotals with one row a group, for groups that still have rows."""
        return self.added(subtotals).where(F.col(ROWS) > 0)

    def result(self, subtotals: DataFrame) -> DataFrame:
        """The table: groups that still have rows."""
        totals = [exact_total({x: F.col(f"{name}_{x}") for x in PARTS}).alias(name) for name in self.sums]
        rows = self.live(subtotals).select(*self.keys, ROWS, *self.counts, *totals)
        return rows.select(*self.keys, *(value.alias(name) for name, value in self.table.items()))


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.col(total), F.col(count))


def _some(total: str, count: str) -> Column:
    """A sum as SQL gives it: NULL where no value was."""
    return F.when(F.col(count) > 0, F.col(total))


def account_facts() -> dict[str, Fact]:
    """A1-A4, from changes of silver accounts."""
    balance = {"sums": {"balances": F.col("balance")}, "counts": {"known": F.col("balance")}}
    return {
        "currency_balance": Fact({"currency": F.col("currency")}, {"total_balance": _some("balances", "known")}, **balance),
        "status_counts": Fact({"status": F.col("status")}, {"total_accounts": F.col(ROWS)}),
        "avg_balance_type": Fact(
            {"account_type": F.col("account_type")}, {"average_balance": _mean("balances", "known")}, **balance
        ),
        "daily_openings": Fact({"date": F.to_date("created_at")}, {"accounts_created": F.col(ROWS)}),
    }


def _amounts(key: str, suffix: str = "") -> Fact:
    return Fact(
        {key: trimmed(F.col(key))},
        {
            f"total_amount{suffix}": _some("amounts", "known"), f"avg_amount{suffix}": _mean("amounts", "known"),
            f"num_transactions{suffix}": F.col(ROWS),
        },
        sums={"amounts": F.col("Amount")},
        counts={"known": F.col("Amount")},
    )


def transaction_facts() -> dict[str, Fact]:
    """A5-A8 and D3, from changes of silver transactions."""
    triple = ("Account_ID", "Transaction_Type", "Currency")
    return {
        "fact_transaction_account": _amounts("Account_ID"),
        "fact_transaction_type": _amounts("Transaction_Type", "_by_type"),
        "fact_transaction_currency": _amounts("Currency", "_by_currency"),
        "fact_transaction_daily": Fact(
            {"transaction_date": F.to_date(to_timestamp(F.col("Transaction_Date")))},
            {"total_amount_per_day": _some("amounts", "known"), "transactions_per_day": F.col(ROWS)},
            sums={"amounts": F.col("Amount")},
            counts={"known": F.col("Amount")},
        ),
        "dim_account_transaction_type": Fact({c: trimmed(F.col(c)) for c in triple}, {}),
    }


def branch_facts(as_of: object = None) -> dict[str, Fact]:
    """A9-A11, from changes of silver branches. The age is that on ``as_of`` for all batches."""
    age = age_in_days(parse_date(F.col("opened_on")), as_of)
    return {
        "fact_branch_country": Fact(
            {"country_region": country_or_unknown(F.col("country"))},
            {"total_branches": F.col(ROWS), "avg_branch_age_days": _mean("ages", "known")},
            sums={"ages": age}, counts={"known": age},
        ),
        "fact_branch_city": Fact({"city": F.col("city")}, {"branches_in_city": F.col(ROWS)}),
    }


@dataclass(frozen=True)
class Maintained:
    """Subtotals of some facts under one folder: ``<fact>/batch=<id>`` of single batches, ``<fact>/upto=<n>``
    of all batches up to n. A reader takes the greatest ``upto`` that was committed and the batches after it.
    """

    spark: SparkSession
    root: str
    facts: Mapping[str, Fact]

    def add(self, changes: DataFrame, batch_id: int) -> None:
        """Writes the subtotals of one batch of changes; a retried batch replaces its own."""
        deltas = {f"{name}/batch={batch_id}": fact.deltas(changes) for name, fact in self.facts.items()}
        side_by_side(*(partial(self._write, rows, path) for path, rows in deltas.items()))

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{path}")

    def _folders(self, name: str) -> list[str]:
        folded = complete_folders(self.spark, f"{self.root}/{name}", "upto")[-1:]
        batches = complete_folders(self.spark, f"{self.root}/{name}", "batch")
        return [*(f"upto={n}" for n in folded), *(f"batch={n}" for n in batches if not folded or n > folded[0])]

    def subtotals(self, name: str) -> DataFrame:
        folders = self._folders(name)
        if not folders:
            raise ValueError(f"{name} has no batch yet under {self.root}")
        return self.spark.read.parquet(*(f"{self.root}/{name}/{f}" for f in folders))

    def table(self, name: str) -> DataFrame:
        return self.facts[name].result(self.subtotals(name))

    def compact(self, name: str) -> None:
        """Folds all batches so far into one folder, without groups that have come to nothing.

        The folders that were folded this time stay until the next, for readers that have begun with them.
        A crash leaves either the old folders or both, and both give the same table.
        """
        at = f"{self.root}/{name}"
        folded, batches = (complete_folders(self.spark, at, key) for key in ("upto", "batch"))
        if not batches or folded and batches[-1] <= folded[-1]:
            return
        self._write(self.facts[name].live(self.subtotals(name)), f"{name}/upto={batches[-1]}")
        for n in folded[:-1]:
            delete_folder(self.spark, f"{at}/upto={n}")
        for n in batches:
            if folded and n <= folded[-1]:
                delete_folder(self.spark, f"{at}/batch={n}")
