"""

Queries only add what a comparison needs: fixed clocks and times without a zone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import partial, reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

sys.path.insert(0, str(Path(__file__).resolve().parent))

from expected_sql import EXPECTED  # noqa: E402
from tributary.operators import explode_parquet_payloads  # noqa: E402
from tributary.plans import gold, refresh, silver  # noqa: E402
from tributary.plans.star import StarTables, star_of_owners  # noqa: E402
from tributary.plans.star import star_transactions as star  # noqa: E402
from tributary.schemas import BRONZE, RAW, REJECTS  # noqa: E402
from tributary.sources import (  # noqa: E402
    copy_new_batches,
    copy_tables,
    read_bronze,
    read_copied,
    read_table,
    scratch_folder,
    write_table,
)
from tributary.sources import sample  # noqa: E402
from tributary.plans.daily import DailyFact  # noqa: E402
from tributary.plans.maintain import (  # noqa: E402
    Fact,
    Maintained,
    account_facts,
    branch_facts,
    transaction_facts,
)
from tributary.streaming import (  # noqa: E402
    current_rows,
    drop_resent,
    landing_table,
    latest_changes,
    read_changes,
    read_landing,
    start_changes,
    start_landing,
    stateful_session,
    visible_events,
)
from tributary.streaming.envelope import TARGET  # noqa: E402
from tributary.streaming.exactly_once import read_landed_once, start_landing_once  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The training-data operators are an optional part: without their package the rest works alone.
LLM_QUERIES: dict[str, Query] = {}
LLM_SQL: dict[str, str] = {}
try:
    from tributary.llm.queries import QUERIES, SQL

    LLM_QUERIES |= QUERIES
    LLM_SQL |= SQL
    import corpus_pipeline

    LLM_QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL is not None:
        LLM_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
except ImportError as missing:
    print(f"without training-data queries: {missing}", file=sys.stderr)

AS_OF, RISK = date(2026, 1, 1), "HIGH"
#: Batches that a stream is fed with, each by a new run from the checkpoint of the one before.
SLICES = 3


def _comparable(df: DataFrame) -> DataFrame:
    """Times without zone, floats as doubles."""

    def column(name: str, dtype: str) -> Column:
        value = F.col(name)
        if dtype == "timestamp":
            value = value.cast("timestamp_ntz")
        elif dtype == "float":
            value = value.cast("double")
        return value.alias(name)

    return df.select([column(name, dtype) for name, dtype in df.dtypes])


def _loaded_at() -> Column:
    """A fixed load time in the time zone of the session."""
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_customers(sample.bronze_customers(spark, folder))


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_accounts(sample.bronze_accounts(spark, folder))


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_transactions(sample.bronze_transactions(spark, folder))


def _branches(spark: SparkSession, folder: str) -> DataFrame:
    return silver.silver_branches(sample.bronze_branches(spark, folder))


def _on(source: Query, step: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    return lambda spark, folder: _comparable(step(source(spark, folder)))


def silver_customers_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(silver.silver_customers(sample.bronze_customers(spark, folder), dedup=True))


def silver_transactions_dedup(spark: SparkSession, folder: str) -> DataFrame:
    bronze = sample.bronze_transactions(spark, folder, copies=True)
    return _comparable(silver.silver_transactions(bronze, dedup=True))


def account_json_flag(spark: SparkSession, folder: str) -> DataFrame:
    flags = silver.account_json_flag(sample.bronze_accounts(spark, folder))
    return flags.groupBy("is_json").agg(F.count("*").alias("bodies"))


def account_status_lookup(spark: SparkSession, folder: str) -> DataFrame:
    accounts = gold.with_status_meaning(_accounts(spark, folder))
    return accounts.select("account_id", "status", "status_meaning")


TRANSACTION_KEYS = {"Account_ID": "string", "Transaction_Type": "string", "Currency": "string", "transaction_date": "date"}


def _stacked(tables: dict[str, DataFrame], keys: dict[str, str], measures: tuple[str, ...]) -> DataFrame:
    """Tables one above the other; measures by the beginning of their names."""

    def columns(df: DataFrame) -> list[Column]:
        found = {m: next((c for c in df.columns if c.startswith(m)), None) for m in measures}
        own = [(F.col(k) if k in df.columns else F.lit(None)).cast(kind).alias(k) for k, kind in keys.items()]
        return own + [(F.col(c) if c else F.lit(None)).cast("double").alias(m) for m, c in found.items()]

    return reduce(DataFrame.union, [df.select(F.lit(name).alias("gold_table"), *columns(df)) for name, df in tables.items()])


def _transaction_tables(tables: dict[str, DataFrame]) -> DataFrame:
    tables = {n: df.withColumnRenamed("transactions_per_day", "num_transactions") for n, df in tables.items()}
    return _stacked(tables, TRANSACTION_KEYS, ("total_amount", "avg_amount", "num_transactions"))


def transaction_tables(spark: SparkSession, folder: str) -> DataFrame:
    """D3 and A5-A8 derived from the two sets of subtotals, stacked into one table."""
    transactions = _transactions(spark, folder)
    return _transaction_tables(
        {
            **gold.account_tables(gold.account_subtotals(transactions)),
            **gold.daily_tables(gold.daily_subtotals(transactions)),
        }
    )


def _in_slices(spark: SparkSession, rows: DataFrame, start: Callable[[DataFrame, str], StreamingQuery]) -> str:
    """Feeds ``rows`` to a stream in batches that arrive in any order of versions, each to a new run of the stream."""
    root = scratch_folder(spark)
    session = stateful_session(spark)
    for number in range(SLICES):
        sample.slice_of(rows, number, SLICES).write.mode("append").parquet(f"{root}/in")
        start(session.readStream.schema(rows.schema).parquet(f"{root}/in"), root).awaitTermination()
    return root


ONCE = {"availableNow": True}


def _latest_by_stream(entity: str, build: Query) -> Query:
    """W1, D1, D2 kept by a stream: the newest rows after all batches."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows, (keys, newest_by) = build(spark, folder), silver.NEWEST[entity]
        versions = silver.VERSIONS[entity]
        root = _in_slices(spark, rows, lambda s, r: start_changes(latest_changes(versions(s), keys, newest_by), r, ONCE))
        found = current_rows(read_changes(spark, root, versions(rows).schema), keys)
        return _comparable(found)

    return query


def _maintained(spark: SparkSession, rows: DataFrame, entity: str, facts: dict[str, Fact]) -> dict[str, DataFrame]:
    """Facts from signed subtotals of each batch of changes."""
    keys, newest_by = silver.NEWEST[entity]

    def start(stream: DataFrame, root: str) -> StreamingQuery:
        changes = latest_changes(silver.VERSIONS[entity](stream), keys, newest_by)
        query = start_changes(changes, root, ONCE, Maintained(spark, f"{root}/facts", facts).add)
        query.awaitTermination()
        for name in facts:
            Maintained(spark, f"{root}/facts", facts).compact(name)
        return query

    kept = Maintained(spark, f"{_in_slices(spark, rows, start)}/facts", facts)
    return {name: kept.table(name) for name in facts}


def maintained_account_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A1-A4 of accounts whose versions arrive late and twice."""
    tables = _maintained(spark, sample.bronze_accounts(spark, folder), "accounts", account_facts())
    tables = {n: df.withColumnsRenamed({"total_accounts": "accounts", "accounts_created": "accounts"}) for n, df in tables.items()}
    keys = {"currency": "string", "status": "string", "account_type": "string", "date": "date"}
    return _stacked(tables, keys, ("total_balance", "average_balance", "accounts"))


def maintained_transaction_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A5-A8, D3 and D4 of transactions that are updated."""
    rows = sample.bronze_transactions(spark, folder, updates=True)
    return _transaction_tables(_maintained(spark, rows, "transactions", transaction_facts()))


def maintained_branch_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A9-A11."""
    tables = _maintained(spark, sample.bronze_branches(spark, folder), "branches", branch_facts(AS_OF))
    tables["fact_branch_city"] = tables["fact_branch_city"].withColumnRenamed("branches_in_city", "total_branches")
    return _stacked(tables, {"country_region": "string", "city": "string"}, ("total_branches", "avg_branch_age_days"))


def _star_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        _transactions(spark, folder),
        gold.dim_account(_accounts(spark, folder)),
        gold.dim_customer(_customers(spark, folder)),
    )


def star_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(star(*_star_sides(spark, folder)))


def star_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """J3 from tables that are bucketed by account."""
    tables = StarTables(spark, scratch_folder(spark))
    tables.write(*_star_sides(spark, folder))
    return _comparable(tables.read())


def star_of_high_risk(spark: SparkSession, folder: str) -> DataFrame:
    """J3 filtered by a dimension."""
    return _comparable(star_of_owners(*_star_sides(spark, folder), F.col("risk_level") == RISK))


def ingest_nonblank(spark: SparkSession, folder: str) -> DataFrame:
    return visible_events(sample.events(spark, folder))


def _landed(table: str) -> Query:
    return lambda spark, folder: landing_table(sample.events(spark, folder), table)


def _landing(spark: SparkSession, folder: str) -> str:
    landing = f"{scratch_folder(spark)}/landing"
    start_landing(sample.event_files(spark, folder), landing, trigger=ONCE).awaitTermination()
    return landing


def _landed_rows(spark: SparkSession, landing: str, read: Callable[..., DataFrame] = read_landing) -> DataFrame:
    """All landing tables in one, with the table that each row is in."""
    tables = [read(spark, landing, t).withColumn(TARGET, F.lit(t)) for t in [*BRONZE, REJECTS]]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), tables)


def stream_route_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Drain the event stream into landing tables, then count what landed where."""
    return spark.read.parquet(_landing(spark, folder)).groupBy(TARGET).agg(F.count("*").alias("events"))


def stream_landing_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all landing tables after the stream has been drained."""
    return _landed_rows(spark, _landing(spark, folder))


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """D4 on the landing stream: events sent again in later batches, and after restarts, land once."""
    root, events = scratch_folder(spark), sample.sent_events(spark, folder)
    for number in range(SLICES):
        sample.resent_slice(events, number).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        start_landing(drop_resent(stream, within="20 days"), f"{root}/landing", trigger=ONCE).awaitTermination()
    return _landed_rows(spark, f"{root}/landing")


def stream_landing_once(spark: SparkSession, folder: str) -> DataFrame:
    """S3 by a sink with a ledger: the rows of all landing tables after three runs of the stream."""
    root, events = scratch_folder(spark), sample.events(spark, folder)
    for number in range(SLICES):
        sample.slice_of(events, number, SLICES).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        start_landing_once(stream, f"{root}/landing", trigger=ONCE).awaitTermination()
    return _landed_rows(spark, f"{root}/landing", read_landed_once)


def parquet_payloads(spark: SparkSession, folder: str) -> DataFrame:
    columns = BRONZE["transactions"].names[:-1]
    rows = explode_parquet_payloads(sample.transaction_payloads(spark, folder), "payload", columns)
    # The text of an amount differs between engines (1.0E7), its value does not.
    amount = F.col("amount").try_cast("double")
    return rows.withColumns({"amount": amount, "raw_text": F.col(RAW).cast("string")}).drop(RAW)


def bronze_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Landing tables copied to bronze: the rows of all four."""
    landing = _landing(spark, folder)
    bronze = f"{scratch_folder(spark)}/bronze"
    copy_tables(partial(read_landing, spark, landing), bronze)
    tables = [read_bronze(spark, bronze, t).withColumn(TARGET, F.lit(t)) for t in BRONZE]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), tables)


def _contents(df: DataFrame) -> DataFrame:
    """Rows and a digest of all columns, whatever the order of rows: the sum of a part of each row's MD5."""

    def text(name: str, kind: str) -> Column:
        value = F.col(name).cast("double") if kind == "float" else F.col(name)
        value = value.cast("decimal(38,3)") if kind in ("float", "double") else value
        return F.coalesce(value.cast("string"), F.lit("~"))

    row = F.md5(F.concat_ws("|", *[text(n, k) for n, k in sorted(df.dtypes, key=lambda c: c[0].lower())]).cast("binary"))
    number = F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(20,0)")
    digest = F.pmod(F.sum(number), F.lit(10**18).cast("decimal(38,0)")).cast("long")
    return df.agg(F.count("*").alias("table_rows"), digest.alias("contents"))


def _refreshed(spark: SparkSession, folder: str, dedup: tuple[str, ...] = (), **sources: Query) -> DataFrame:
    """Write bronze, refresh silver and gold, and tell what every gold table holds."""
    root = scratch_folder(spark)
    lake = refresh.Lakehouse(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", as_of=AS_OF, loaded_at=_loaded_at(), dedup=dedup
    )
    refresh.side_by_side(
        *(
            partial(write_table, build(spark, folder), lake.bronze, entity)
            for entity, build in {**sample.BRONZE_TABLES, **sources}.items()
        )
    )
    refresh.run_all(lake)
    found = [
        _contents(read_table(spark, lake.gold, name)).withColumn("gold_table", F.lit(name)) for name in refresh.GOLD_TABLES
    ]
    return reduce(DataFrame.unionByName, found)


def run_all(spark: SparkSession, folder: str) -> DataFrame:
    return _refreshed(spark, folder)


def run_all_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The refresh over transactions that are updated, the newest of each kept."""
    return _refreshed(
        spark, folder, ("customers", "transactions"), transactions=partial(sample.bronze_transactions, updates=True)
    )


def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    """malformed values by column, counted while silver is written."""
    root = scratch_folder(spark)
    lake = refresh.Lakehouse(spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold")

    def written(entity: str, build: Query) -> None:
        write_table(build(spark, folder), lake.bronze, entity)
        lake.refresh_silver(entity)

    refresh.side_by_side(*(partial(written, entity, build) for entity, build in sample.BRONZE_TABLES.items()))
    return lake.flags()


def fact_transaction_daily_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """A8 of transactions in two batches of years, then late ones of one month: each replaces its days."""
    kept = DailyFact(spark, scratch_folder(spark), by="yyyy-MM")
    bronze = sample.bronze_transactions(spark, folder)
    late = F.col("transaction_date").startswith("1996-03") & (F.crc32(F.col("transaction_id").cast("binary")) % 3 == 0)
    batch = F.when(late, 2).when(F.col("transaction_date") < "1998-07-01", 0).otherwise(1)
    for number in range(SLICES):
        kept.add(silver.silver_transactions(bronze.where(batch == number)), number)
    return kept.table()


def bronze_by_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Landing tables copied batch by batch: the rows of all four."""
    root, events = scratch_folder(spark), sample.events(spark, folder)
    for number in range(SLICES):
        sample.slice_of(events, number, SLICES).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        start_landing(stream, f"{root}/landing", trigger=ONCE).awaitTermination()
        copy_new_batches(spark, f"{root}/landing", f"{root}/bronze")
    tables = [read_copied(spark, f"{root}/bronze", t).withColumn(TARGET, F.lit(t)) for t in BRONZE]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), tables)


def silver_transactions_updates(spark: SparkSession, folder: str) -> DataFrame:
    bronze = sample.bronze_transactions(spark, folder, updates=True)
    return _comparable(silver.silver_transactions(bronze, dedup=True))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the account metrics of the smallest sample."""
    return queries()["fact_account_metrics"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator or table: ``(spark, folder) -> DataFrame``."""
    return {
        "silver_customers": _on(_customers),
        "silver_customers_dedup": silver_customers_dedup,
        "silver_transactions": _on(_transactions),
        "silver_transactions_dedup": silver_transactions_dedup,
        "silver_accounts": _on(_accounts),
        "silver_branches": _on(_branches),
        "silver_transactions_updates": silver_transactions_updates,
        "account_json_flag": account_json_flag,
        "customer_latest": _on(_customers, gold.customer_latest),
        "dim_customer": _on(_customers, lambda df: gold.dim_customer(df, _loaded_at())),
        "dim_account": _on(_accounts, gold.dim_account),
        "dim_branch": _on(_branches, gold.dim_branch),
        "dim_transaction": _on(_transactions, gold.dim_transaction),
        "dim_account_transaction_type": _on(_transactions, gold.dim_account_transaction_type),
        "account_enriched": _on(_accounts, gold.account_enriched),
        "account_status_lookup": account_status_lookup,
        "currency_balance": _on(_accounts, gold.currency_balance),
        "status_counts": _on(_accounts, gold.status_counts),
        "avg_balance_type": _on(_accounts, gold.avg_balance_type),
        "daily_openings": _on(_accounts, gold.daily_openings),
        "fact_account_metrics": _on(_accounts, gold.fact_account_metrics),
        "fact_branch_country": _on(_branches, lambda df: gold.fact_branch_country(df, AS_OF)),
        "fact_branch_city": _on(_branches, gold.fact_branch_city),
        "fact_transaction_account": _on(_transactions, gold.fact_transaction_account),
        "fact_transaction_type": _on(_transactions, gold.fact_transaction_type),
        "fact_transaction_currency": _on(_transactions, gold.fact_transaction_currency),
        "fact_transaction_daily": _on(_transactions, gold.fact_transaction_daily),
        "transaction_tables": transaction_tables,
        "star_transactions": star_transactions,
        "star_bucketed": star_bucketed,
        "star_of_high_risk": star_of_high_risk,
        "preview_transactions": _on(
            _transactions, lambda df: gold.preview(gold.dim_transaction(df), "Transaction_ID")
        ),
        "ingest_nonblank": ingest_nonblank,
        "ingest_customers": _landed("customers"),
        "ingest_accounts": _landed("accounts"),
        "ingest_transactions": _landed("transactions"),
        "ingest_branches": _landed("branches"),
        "ingest_rejects": _landed(REJECTS),
        "stream_route_counts": stream_route_counts,
        "parquet_payloads": parquet_payloads,
        "bronze_copy": bronze_copy,
        "run_all": run_all,
        "run_all_dedup": run_all_dedup,
        "quality_flags": quality_flags,
        "fact_transaction_daily_by_day": fact_transaction_daily_by_day,
        "bronze_by_ledger": bronze_by_ledger,
        "stream_landing_rows": stream_landing_rows,
        "stream_landing_once": stream_landing_once,
        "stream_dedup": stream_dedup,
        "customer_latest_stream": _latest_by_stream("customers", sample.bronze_customers),
        "account_latest_stream": _latest_by_stream("accounts", sample.bronze_accounts),
        "maintained_account_facts": maintained_account_facts,
        "maintained_transaction_facts": maintained_transaction_facts,
        "maintained_branch_facts": maintained_branch_facts,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """For each query the SQL that gives its expected result on the source tables."""
    return {**EXPECTED, **LLM_SQL}
