"""Bronze tables and an event stream derived from TPC-H-like tables.

Every irregularity (missing ids, bad dates, unreadable bodies, second versions of a row) is a fixed
function of the source key, so the expected results can be stated on the source tables.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.schemas import BRONZE, RAW


# The source columns used here. Naming them saves a look into file footers.
SOURCES = {
    "customer": "c_custkey long, c_nationkey int, c_acctbal double",
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id long, user_id long, event_type string, value double",
}


def _source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCES[table]).parquet(f"{folder}/{table}.parquet")


def _key(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _versions(condition: Column) -> Column:
    """Explodes to 0, or to 0 and 1 where ``condition`` holds."""
    return F.explode(
        F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    )


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _created(n: Column, days_later: Column) -> Column:
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (n % 28).cast("int") + days_later)
    hour = F.lpad((n % 24).cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit(" "), hour, F.lit(":00:00"))


def _currency(n: Column) -> Column:
    return F.when(n % 4 == 0, "USD").when(n % 4 == 1, "EUR").otherwise("PKR")


def _raw_only(df: DataFrame, entity: str) -> DataFrame:
    return df.select(
        *[
            F.col(f.name) if f.name == RAW else F.lit(None).cast("string").alias(f.name)
            for f in BRONZE[entity].fields
        ]
    )


def bronze_accounts(spark: SparkSession, folder: str) -> DataFrame:
    n, version = F.col("n"), F.col("version")
    body = F.struct(
        _unless(n % 41 == 0, _key("ACC-", n)).alias("account_id"),
        _unless(n % 82 == 0, _key("CUST-", n)).alias("customer_id"),
        F.when(n % 5 == 0, "Savings")
        .when(n % 5 == 1, "Current")
        .otherwise("Fixed")
        .alias("account_type"),
        (F.col("c_acctbal") + 100 * version).alias("balance"),
        F.when(n % 53 == 0, "GBP").otherwise(_currency(n)).alias("currency"),
        F.when(n % 59 == 0, "bad-date").otherwise(_created(n, version)).alias("created_at"),
        _unless(
            n % 47 == 0,
            F.when(n % 3 == 0, "active").when(n % 3 == 1, "inactive").otherwise("blocked"),
        ).alias("status"),
    )
    rows = _source(spark, folder, "customer").select(
        F.col("c_custkey").alias("n"),
        "c_acctbal",
        _versions(F.col("c_custkey") % 10 == 0).alias("version"),
    )
    raw = F.when(n % 43 == 0, "not json {").otherwise(F.to_json(body))
    return _raw_only(rows.select(raw.alias(RAW)), "accounts")


def bronze_transactions(
    spark: SparkSession, folder: str, copies: bool = False, updates: bool = False
) -> DataFrame:
    """``copies``: exact second rows; ``updates``: second rows with another amount and type a day later, every
    other one with a bad date, so that the older row wins."""
    n = F.col("n")
    rows = _source(spark, folder, "orders").withColumn("n", F.col("o_orderkey"))
    if copies or updates:
        rows = rows.withColumn("version", _versions(n % 20 == 0))
    if updates:
        version = F.col("version")
        rows = rows.withColumns(
            {
                "o_totalprice": F.col("o_totalprice") + 5 * version,
                "o_orderdate": F.expr("o_orderdate + make_interval(0, 0, 0, version)"),
                "o_orderpriority": F.when(version == 1, "0-UPDATED").otherwise(F.col("o_orderpriority")),
                "bad": (n % 79 == 0) | ((version == 1) & (n % 40 == 0)),
            }
        )
    else:
        rows = rows.withColumn("bad", n % 79 == 0)
    day = F.to_date("o_orderdate").cast("string")
    return rows.select(
        _unless(n % 61 == 0, _key("TX-", n)).alias("transaction_id"),
        _unless(n % 67 == 0, _key("ACC-", F.col("o_custkey"))).alias("account_id"),
        F.when(n % 2 == 0, "credit").otherwise(" debit").alias("transaction_type"),
        F.when(n % 71 == 0, "abc")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("amount"),
        F.when(n % 73 == 0, "USD ").otherwise(_currency(n)).alias("currency"),
        F.when(F.col("bad"), "bad-date")
        .otherwise(F.concat(day, F.lit(" 10:00:00")))
        .alias("transaction_date"),
        F.concat(F.lit("order "), "o_orderpriority").alias("description"),
        F.lit(None).cast("string").alias(RAW),
    )


def _with_nation(rows: DataFrame, nation_key: str, nations: DataFrame) -> DataFrame:
    return rows.join(nations, rows[nation_key] == nations["n_nationkey"], "left")


def bronze_branches(spark: SparkSession, folder: str) -> DataFrame:
    n, version = F.col("n"), F.col("version")
    rows = _with_nation(
        _source(spark, folder, "supplier"), "s_nationkey", _source(spark, folder, "nation")
    ).select(
        F.col("s_suppkey").alias("n"),
        "s_name",
        "n_name",
        _versions(F.col("s_suppkey") % 4 == 0).alias("version"),
    )
    city = _unless(n % 9 == 0, _key("CITY_", n % 6))
    year = _key("20", n % 10 + 10)
    body = F.struct(
        _unless(n % 17 == 0, _key("BR-", n)).alias("branch_id"),
        F.col("s_name").alias("branch_name"),
        _key("1, High St, Block ", n % 8).alias("address"),
        F.when(version == 1, "CITY_Z").otherwise(city).alias("city"),
        _unless(n % 7 == 0, F.col("n_name")).alias("country"),
        _unless(
            n % 5 == 0,
            F.when(n % 6 == 0, "unknown").otherwise(F.concat(year, F.lit("-03-04"))),
        ).alias("opened_on"),
    )
    return _raw_only(rows.select(F.to_json(body).alias(RAW)), "branches")


def bronze_customers(spark: SparkSession, folder: str) -> DataFrame:
    n, version = F.col("n"), F.col("version")
    rows = _with_nation(
        _source(spark, folder, "customer"), "c_nationkey", _source(spark, folder, "nation")
    ).select(
        F.col("c_custkey").alias("n"),
        "n_name",
        _versions(F.col("c_custkey") % 10 == 0).alias("version"),
    )
    street = F.concat(n.cast("string"), F.lit(" Main St"))
    zip_code = F.concat(F.lit("9"), F.lpad((n % 10000).cast("string"), 4, "0"))
    return rows.select(
        _unless(n % 37 == 0, _key("CUST-", n)).alias("CustomerID"),
        F.lit("Customer").alias("FirstName"),
        _unless(n % 11 == 0, n.cast("string")).alias("LastName"),
        F.concat(F.lit("c"), n.cast("string"), F.lit("@example.org")).alias("Email"),
        _key("+1 (555) 000-", n).alias("Phone"),
        F.when(n % 3 == 0, F.concat(street, F.lit("\nSpringfield, CA "), zip_code))
        .when(n % 3 == 1, F.concat(street, F.lit("\nPSC 12, Box 3\nAPO AA 34021")))
        .otherwise(street)
        .alias("Address"),
        _key("CITY_", n % 6).alias("City"),
        F.col("n_name").alias("Country"),
        F.when((version == 1) & (n % 20 == 0), "bad-date")
        .otherwise(_created(n, version))
        .alias("CreatedAt"),
        F.lit(None).cast("string").alias(RAW),
    )


BRONZE_TABLES = {
    "customers": bronze_customers,
    "accounts": bronze_accounts,
    "transactions": bronze_transactions,
    "branches": bronze_branches,
}


# Bodies that try to close the array they are parsed in.
FORGED = '{"amount":1},{"end-of-body":""}] junk'


def event_bodies(events: DataFrame, *others: str | Column) -> DataFrame:
    """``events`` rows (batch or stream) as ``(topic, body)``, after other columns."""
    n, user = F.col("event_id"), F.col("user_id").cast("string")
    kind = F.col("event_type")
    topic = (
        F.when(kind == "signup", "customers-topic")
        .when(kind == "view", "accounts-topic")
        .when(kind.isin("purchase", "error"), "transactions-topic")
        .when(kind == "click", "branches-topic")
    )
    customer = F.to_json(F.struct(F.concat(F.lit("CUST-"), user).alias("CustomerID")))
    account = F.concat(F.lit("ACC-"), user).alias("account_id")
    other = F.to_json(F.struct(account, F.col("value").alias("amount")))
    body = (
        F.when(n % 13 == 0, "   ")
        .when(n % 17 == 0, "not json")
        .when(n % 19 == 0, "[1]")
        .when(n % 23 == 0, '{"account_id":"x","zzz":1}')
        .when(n % 29 == 0, FORGED)
        .when(n % 31 == 0, '5,"end-of-body"] junk')
        .when(kind == "signup", customer)
        .otherwise(other)
    )
    return events.select(*others, topic.alias("topic"), body.alias("body"))


def slice_of(rows: DataFrame, number: int, slices: int) -> DataFrame:
    """The rows that arrive as batch ``number``, by content: versions of a key come in any order."""
    return rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(slices)) == number)


def sent_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with their id and the time they were sent."""
    rows = spark.read.schema(f"{SOURCES['events']}, ts timestamp_ntz").parquet(f"{folder}/events.parquet")
    return event_bodies(rows, "event_id", F.col("ts").cast("timestamp").alias("sent_at"))


def resent_slice(events: DataFrame, number: int, days: int = 10) -> DataFrame:
    """The events of one span of ``days`` in January 2024, and once more each third one of the span before."""
    start = F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(F.lit(number * days))
    since = (F.unix_micros("sent_at") - F.unix_micros(start)) / (86_400_000_000 * days)
    own, again = (since >= 0) & (since < 1), (since >= -1) & (since < 0) & (F.col("event_id") % 3 == 0)
    return events.where(own | again)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return event_bodies(_source(spark, folder, "events"))


def event_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same events as a file stream. The glob lets the path be one file or a folder of files."""
    files = spark.readStream.schema(SOURCES["events"])
    return event_bodies(files.parquet(f"{folder}/events.parque[t]"))


def transaction_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze transactions packed as Parquet messages, one per Arrow batch.

    Rows without an account travel as messages of their own that are not Parquet.
    """
    rows = bronze_transactions(spark, folder).drop(RAW)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stray = pc.is_null(batch.column("account_id"))
            junk = batch.filter(stray).column("description").to_pylist()
            messages = [text.encode() for text in junk]
            good = batch.filter(pc.invert(stray))
            if good.num_rows:
                out = io.BytesIO()
                pq.write_table(pa.Table.from_batches([good]), out)
                messages.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(messages, pa.binary())], ["payload"])

    return rows.mapInArrow(pack, "payload binary")
