"""The star: transactions with their account and customer."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import enrich, may_be_among
from tributary.operators.enrich import KEY, MAX_PARTS, MIN_PART_ROWS, PART, hot_buckets, in_parts, key_type
from tributary.plans.gold import transactions_clean

FACTS = ("Transaction_ID", "Account_ID", "Transaction_Type", "Amount", "Currency", "transaction_ts")
OWNED = ("customer_id", "account_type", "account_status", "risk_level", "Full_Name", "City", "Country")
_FOUND = "_found"


def _facts(transactions: DataFrame) -> DataFrame:
    return transactions_clean(transactions).select(*FACTS)


def _owned(accounts: DataFrame, customers: DataFrame, **limits: int) -> DataFrame:
    """Accounts with their customers, at the size of the account table."""
    account_columns = accounts.select(
        F.col("account_id").alias("Account_ID"),
        "customer_id",
        "account_type",
        F.col("status").alias("account_status"),
        "risk_level",
    )
    customer_columns = customers.select(
        F.col("Customer_ID").alias("customer_id"), "Full_Name", "City", "Country"
    )
    return enrich(account_columns, customer_columns, "customer_id", **limits)


def star_transactions(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    where: Column | None = None,
    **limits: int,
) -> DataFrame:
    """Silver transactions left join ``dim_account`` left join ``dim_customer``.

    Accounts meet their customers first, at the size of the account table, so the transactions are
    shuffled once and not twice. Unknown ids keep their row, with NULL attributes.
    ``where`` selects transactions; given here it reaches their scan, also that of the key counts.
    """
    if where is not None:
        transactions = transactions.filter(where)
    owned = _owned(accounts, customers, **limits)
    return enrich(_facts(transactions), owned, "Account_ID", **limits).select(*FACTS, *OWNED)


def star_of_owners(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame, owners: Column, **limits: int
) -> DataFrame:
    """Rows of the star whose account exists and has ``owners`` hold for its attributes (``OWNED``).

    The accounts are selected first. A Bloom filter of them, of bounded size, then keeps most
    transactions of other accounts out of the shuffle; the join removes the rest.
    """
    chosen = _owned(accounts, customers, **limits).filter(owners)
    facts = may_be_among(_facts(transactions), chosen, "Account_ID")
    found = enrich(facts, chosen.withColumn(_FOUND, F.lit(True)), "Account_ID", **limits)
    return found.filter(F.col(_FOUND)).select(*FACTS, *OWNED)


@dataclass(frozen=True)
class StarTables:
    """Both sides of the star, written bucketed by account, so that it can be read again and again without a shuffle.

    ``<name>_facts`` and ``<name>_accounts`` are tables of the session's catalog with files under ``root``. Hot accounts
    are split as in ``enrich``: the part of a fact is stored with it and buckets are by key and part, so no
    bucket holds more than its share of a hot account. ``buckets`` is the session's number of shuffle partitions
    unless given; choose it so that a bucket of facts is a few hundred MB.
    """

    spark: SparkSession
    root: str
    name: str = field(default_factory=lambda: f"star_{uuid.uuid4().hex}")
    buckets: int | None = None

    def write(
        self,
        transactions: DataFrame,
        accounts: DataFrame,
        customers: DataFrame,
        max_parts: int = MAX_PARTS,
        min_part_rows: int = MIN_PART_ROWS,
    ) -> None:
        """Replaces both tables. The facts are shuffled here, once."""
        limits = {"max_parts": max_parts, "min_part_rows": min_part_rows}
        facts, owned = _facts(transactions), _owned(accounts, customers, **limits)
        kind = key_type(facts, owned, "Account_ID")
        # Written, so that both sides are split alike even if they are written again after a failure.
        hot_buckets(facts, "Account_ID", kind, **limits).write.mode("overwrite").parquet(f"{self.root}/hot")
        split, copied = in_parts(facts, owned, "Account_ID", kind, self.spark.read.parquet(f"{self.root}/hot"))
        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for side, df in (("facts", split), ("accounts", copied)):
            # One task and one file for each bucket.
            writer = df.repartition(buckets, KEY, PART).write.mode("overwrite").bucketBy(buckets, KEY, PART).sortBy(KEY, PART)
            writer.option("path", f"{self.root}/{side}").saveAsTable(f"{self.name}_{side}")

    def read(self, where: Column | None = None) -> DataFrame:
        """As ``star_transactions``; ``where`` selects facts, down to their scan."""
        facts, owned = (self.spark.table(f"{self.name}_{side}") for side in ("facts", "accounts"))
        if where is not None:
            facts = facts.filter(where)
        return facts.join(owned, [KEY, PART], "left").select(*FACTS, *OWNED)
