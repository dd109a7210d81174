"""Bronze to silver: one ``DataFrame -> DataFrame`` function per entity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.functions import (
    dashes_for_commas,
    digits_only,
    full_name,
    looks_like_json_object,
    parse_date,
    parse_float,
    parse_timestamp,
)
from tributary.operators import keep_latest, parse_json_text
from tributary.schemas import ACCOUNT_BODY, BRANCH_BODY, RAW


Flags = Observation | str | None

# What identifies an entity, and by what its newest row is told.
NEWEST = {
    "customers": (["Customer_ID"], ["Created_At"]),
    "accounts": (["account_id"], ["created_at"]),
    "transactions": (["Transaction_ID"], ["Transaction_Date"]),
    "branches": (["branch_id"], []),
}


# Columns whose text must have a form: what is not read becomes NULL, and is counted.
_PARSED = "_{}_value"


def _parsed(rows: DataFrame, parsers: dict[str, Callable[[Column], Column]], flags: Flags) -> DataFrame:
    """Adds the values of text columns, parsed once, and counts text without a value as rows pass by.

    ``flags`` is an ``Observation``, or in a stream a name under which its progress has the counts.
    """
    rows = rows.withColumns({_PARSED.format(c): parse(F.col(c)) for c, parse in parsers.items()})
    if flags is None:
        return rows
    bad = {c: F.col(c).isNotNull() & F.col(_PARSED.format(c)).isNull() for c in parsers}
    return rows.observe(flags, *(F.count_if(where).alias(c) for c, where in bad.items()))


def silver_customers(bronze: DataFrame, dedup: bool = False, flags: Flags = None) -> DataFrame:
    """P1, F1, P9, F2, P2, F3; with ``dedup`` the newest row per customer."""
    named = bronze.filter(F.col("CustomerID").isNotNull())
    rows = _parsed(named, {"CreatedAt": parse_timestamp}, flags).select(
        F.col("CustomerID").alias("Customer_ID"),
        full_name(F.col("FirstName"), F.col("LastName")).alias("Full_Name"),
        "Email",
        digits_only(F.col("Phone")).alias("Phone"),
        "Address",
        "City",
        "Country",
        F.col(_PARSED.format("CreatedAt")).alias("Created_At"),
    )
    return keep_latest(rows, *NEWEST["customers"]) if dedup else rows


def silver_transactions(bronze: DataFrame, dedup: bool = False, flags: Flags = None) -> DataFrame:
    """P3, P10, F3, F5, F6; with ``dedup`` the newest row per transaction."""
    named = bronze.filter(F.col("transaction_id").isNotNull() & F.col("account_id").isNotNull())
    rows = _parsed(named, {"amount": parse_float, "transaction_date": parse_timestamp}, flags).select(
        F.col("transaction_id").alias("Transaction_ID"),
        F.col("account_id").alias("Account_ID"),
        F.upper("transaction_type").alias("Transaction_Type"),
        F.col(_PARSED.format("amount")).alias("Amount"),
        F.col("currency").alias("Currency"),
        F.col(_PARSED.format("transaction_date")).alias("Transaction_Date"),
        F.col("description").alias("Description"),
    )
    return keep_latest(rows, *NEWEST["transactions"]) if dedup else rows


def account_versions(bronze: DataFrame, flags: Flags = None) -> DataFrame:
    """Every version of every account, batch or stream.

    Times are parsed before the newest row is picked, so they compare as times and not as text.
    """
    parsed = parse_json_text(bronze, RAW, ACCOUNT_BODY)
    identified = parsed.dropna(how="all", subset=["account_id", "customer_id"])
    timed = _parsed(identified, {"created_at": parse_timestamp}, flags)
    own = _PARSED.format("created_at")
    return timed.withColumn("created_at", F.col(own)).drop(own)


def silver_accounts(bronze: DataFrame, flags: Flags = None) -> DataFrame:
    """P4, P6, P11, D1, F3."""
    return keep_latest(account_versions(bronze, flags), *NEWEST["accounts"])


def branch_versions(bronze: DataFrame, flags: Flags = None) -> DataFrame:
    """Every version of every branch, batch or stream, address and opening day as sent.

    The day is parsed on the way to gold (F12), here it is only looked at.
    """
    named = parse_json_text(bronze, RAW, BRANCH_BODY).dropna(subset=["branch_id"])
    if flags is None:
        return named
    return _parsed(named, {"opened_on": parse_date}, flags).drop(_PARSED.format("opened_on"))


def silver_branches(bronze: DataFrame, flags: Flags = None) -> DataFrame:
    """P5, P6, P12, D2, F7. A branch has no version time; the greatest row wins."""
    latest = keep_latest(branch_versions(bronze, flags), *NEWEST["branches"])
    return latest.withColumn("address", dashes_for_commas(F.col("address")))


def account_json_flag(bronze: DataFrame) -> DataFrame:
    """Each account body with the flag that tells whether it has the shape of an object."""
    return bronze.select(RAW, looks_like_json_object(F.col(RAW)).alias("is_json"))


# Versions of silver rows, none left out: what a stream of changes is made from.
VERSIONS = {
    "customers": silver_customers,
    "accounts": account_versions,
    "transactions": silver_transactions,
    "branches": branch_versions,
}

SILVER_TABLES = {
    "customers": silver_customers,
    "accounts": silver_accounts,
    "transactions": silver_transactions,
    "branches": silver_branches,
}
