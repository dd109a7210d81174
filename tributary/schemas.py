"""Entity schemas of the landing, bronze and silver layers.

Column order is part of the contract. Landing and bronze hold text only; silver is typed.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    FloatType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RAW = "raw_data"


def _text(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


# The columns of the four landing tables.
BRONZE = {
    "customers": _text(
        "CustomerID", "FirstName", "LastName", "Email", "Phone", "Address", "City", "Country",
        "CreatedAt", RAW,
    ),
    "accounts": _text(
        "account_id", "customer_id", "account_type", "balance", "currency", "created_at", "status",
        RAW,
    ),
    "transactions": _text(
        "transaction_id", "account_id", "transaction_type", "amount", "currency",
        "transaction_date", "description", RAW,
    ),
    "branches": _text(
        "branch_id", "branch_name", "address", "city", "country", "phone", "manager_name", RAW,
    ),
}

# Which landing table each topic feeds. Other topics are ignored.
TOPICS = {
    "customers-topic": "customers",
    "accounts-topic": "accounts",
    "transactions-topic": "transactions",
    "branches-topic": "branches",
}

# Topics whose bodies are parsed at ingest; the bodies of the other two stay raw until silver.
PARSED_TABLES = ("customers", "transactions")
REJECTS = "rejects"

# JSON bodies parsed on the way to silver.
ACCOUNT_BODY = StructType(
    [
        StructField("account_id", StringType(), True),
        StructField("customer_id", StringType(), True),
        StructField("account_type", StringType(), True),
        StructField("balance", DoubleType(), True),
        StructField("currency", StringType(), True),
        StructField("created_at", StringType(), True),
        StructField("status", StringType(), True),
    ]
)
BRANCH_BODY = _text("branch_id", "branch_name", "address", "city", "country", "opened_on")

# The columns of the silver tables.
SILVER = {
    "customers": StructType(
        [
            *_text(
                "Customer_ID", "Full_Name", "Email", "Phone", "Address", "City", "Country"
            ).fields,
            StructField("Created_At", TimestampType(), True),
        ]
    ),
    "accounts": StructType(
        [
            StructField("created_at", TimestampType(), True) if f.name == "created_at" else f
            for f in ACCOUNT_BODY.fields
        ]
    ),
    "transactions": StructType(
        [
            *_text("Transaction_ID", "Account_ID", "Transaction_Type").fields,
            StructField("Amount", FloatType(), True),
            StructField("Currency", StringType(), True),
            StructField("Transaction_Date", TimestampType(), True),
            StructField("Description", StringType(), True),
        ]
    ),
    "branches": BRANCH_BODY,
}
