"""Silver and gold tables: edge rows, relations between facts, and the full refresh."""

from __future__ import annotations

import json
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tributary.plans import gold, refresh, silver
from tributary.operators import may_be_among
from tributary.operators.keyset import filter_words
from tributary.plans.star import OWNED, StarTables, star_of_owners, star_transactions
from tributary.schemas import ACCOUNT_BODY, BRONZE, SILVER
from tributary.sources import read_bronze, read_table, sample, write_table

SF = "/root/testdata/sf0.001"
AS_OF, LOADED_AT = date(2026, 1, 1), datetime(2026, 1, 1)


def values(df, places=6) -> Counter:
    def plain(v):
        return round(v, places) if isinstance(v, float) else v

    return Counter(tuple(plain(v) for v in row) for row in df.collect())


def shape(schema) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


@pytest.fixture
def bodies(spark):
    """Bronze rows of an entity whose bodies are the given JSON values or texts."""

    def build(entity, *items):
        texts = [i if isinstance(i, str) else json.dumps(i) for i in items]
        width = len(BRONZE[entity].fields) - 1
        return spark.createDataFrame([(*[None] * width, t) for t in texts], BRONZE[entity])

    return build


# --- silver ----------------------------------------------------------------------------------


@pytest.mark.parametrize("entity", sorted(silver.SILVER_TABLES))
def test_silver_schema(spark, entity):
    rows = silver.SILVER_TABLES[entity](sample.BRONZE_TABLES[entity](spark, SF))
    assert shape(rows.schema) == shape(SILVER[entity])


def test_accounts_need_one_of_two_ids(bodies):
    rows = silver.silver_accounts(
        bodies(
            "accounts",
            {"customer_id": "c", "balance": 1},
            {"account_id": "a", "balance": "1.5"},
            {"balance": 3},
            "not json",
        )
    )
    assert values(rows.select("account_id", "customer_id", "balance")) == Counter(
        {(None, "c", 1.0): 1, ("a", None, None): 1}
    )


def test_accounts_without_id_collapse_to_one(bodies):
    rows = silver.silver_accounts(bodies("accounts", {"customer_id": "c"}, {"customer_id": "d"}))
    assert [r.customer_id for r in rows.collect()] == ["d"]


def test_newest_account_wins_and_a_malformed_time_is_oldest(bodies):
    def account(created, balance):
        return {"account_id": "a", "created_at": created, "balance": balance}

    rows = silver.silver_accounts(
        bodies(
            "accounts",
            account("zzz", 3.0),
            account("2024-01-02 00:00:00", 2.0),
            account("2024-01-01 00:00:00", 1.0),
        )
    )
    assert [(r.balance, r.created_at) for r in rows.collect()] == [(2.0, datetime(2024, 1, 2))]


def test_branches_need_an_id_and_lose_commas(bodies):
    rows = silver.silver_branches(
        bodies(
            "branches",
            {"branch_id": "b", "address": "1, High St, X", "phone": "1"},
            {"branch_name": "n"},
        )
    )
    assert [(r.branch_id, r.address, r.opened_on) for r in rows.collect()] == [
        ("b", "1- High St- X", None)
    ]


def test_transactions_need_both_ids_and_are_not_deduplicated(rows):
    frame = rows(
        BRONZE["transactions"],
        ("t", "a", " debit", "0.1", "USD", "2024-01-02 03:04:05", "d", None),
        ("t", "a", " debit", "0.1", "USD", "2024-01-02 03:04:05", "d", None),
        (None, "a", None, None, None, None, None, None),
        ("t", None, None, None, None, None, None, None),
    )
    out = silver.silver_transactions(frame)
    assert [(r.Transaction_Type, r.Transaction_Date) for r in out.collect()] == [
        (" DEBIT", datetime(2024, 1, 2, 3, 4, 5))
    ] * 2
    assert silver.silver_transactions(frame, dedup=True).count() == 1


def test_not_null_filters_reach_the_scan(spark, tmp_path):
    write_table(sample.bronze_transactions(spark, SF), str(tmp_path), "transactions")
    rows = silver.silver_transactions(read_bronze(spark, str(tmp_path), "transactions"))
    plan = rows.groupBy("Currency").count()._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(transaction_id), IsNotNull(account_id)" in plan
    assert "ReadSchema: struct<transaction_id:string,account_id:string,currency:string>" in plan


# --- gold ------------------------------------------------------------------------------------


def test_customer_dates_beat_a_missing_date(rows):
    frame = rows(
        SILVER["customers"],
        ("c", "N", "e", " 12 ", "one\nX, CA 90210\nlost", "T", "L", datetime(2024, 1, 1)),
        ("c", "N", "e", "99", "other", "T", "L", None),
    )
    (row,) = gold.dim_customer(frame, LOADED_AT).collect()
    assert row.asDict() == {
        "Customer_ID": "c", "Full_Name": "N", "Email": "e", "City": "T", "Country": "L",
        "Phone_Number": "12", "Address_Line1": "one", "Address_Line2": "X, CA 90210",
        "State": "CA", "Postal_Code": "90210", "record_created_date": LOADED_AT,
        "is_active": True, "source_system": "core_banking_system",
    }


def test_customer_stamp_defaults_to_now(rows):
    frame = rows(SILVER["customers"], ("c", "N", "e", "1", "a", "T", "L", None))
    stamp = F.col("record_created_date")
    fresh = F.abs(F.unix_timestamp(stamp) - F.unix_timestamp(F.current_timestamp())) < 120
    assert gold.dim_customer(frame).filter(fresh).count() == 1


def test_branch_age_of_an_all_null_country(rows):
    frame = rows(
        SILVER["branches"],
        ("1", "n", "a", "c", None, None),
        ("2", "n", "a", "c", None, "unknown"),
        ("3", "n", "a", None, "PK", "2025-12-31"),
    )
    assert values(gold.fact_branch_country(frame, AS_OF)) == Counter(
        {("Unknown", 2, None): 1, ("PK", 1, 1.0): 1}
    )
    assert values(gold.fact_branch_city(frame)) == Counter({("c", 2): 1, (None, 1): 1})


def test_country_facts_take_one_shuffle(rows):
    frame = rows(SILVER["branches"], ("1", "n", "a", "c", None, None))
    plan = gold.fact_branch_country(frame, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_metrics_of_no_accounts(spark):
    assert gold.fact_account_metrics(spark.createDataFrame([], SILVER["accounts"])).count() == 0


def test_metrics_are_the_product_of_the_four_facts(spark):
    accounts = silver.silver_accounts(sample.bronze_accounts(spark, SF))
    metrics = gold.fact_account_metrics(accounts)
    product = 1
    for fact in gold.ACCOUNT_FACTS.values():
        product *= fact(accounts).count()
    assert metrics.columns == [
        "currency", "total_balance", "status", "total_accounts", "account_type",
        "average_balance", "date", "accounts_created",
    ]
    assert metrics.count() == product > 0


def test_null_statuses_get_no_meaning(bodies):
    accounts = silver.silver_accounts(
        bodies("accounts", {"account_id": "a", "status": "blocked"}, {"account_id": "b"})
    )
    found = gold.with_status_meaning(accounts).select("account_id", "status_meaning")
    assert values(found) == Counter({("a", "Account is restricted/flagged"): 1, ("b", None): 1})


@pytest.fixture(scope="module")
def transactions(spark):
    return silver.silver_transactions(sample.bronze_transactions(spark, SF))


def test_transaction_facts_agree_on_totals(transactions):
    totals = [
        fact(transactions).agg(F.sum(total), F.sum(count)).first()
        for fact, total, count in (
            (gold.fact_transaction_account, "total_amount", "num_transactions"),
            (gold.fact_transaction_type, "total_amount_by_type", "num_transactions_by_type"),
            (
                gold.fact_transaction_currency,
                "total_amount_by_currency",
                "num_transactions_by_currency",
            ),
            (gold.fact_transaction_daily, "total_amount_per_day", "transactions_per_day"),
        )
    ]
    assert {row[1] for row in totals} == {transactions.count()}
    assert {round(row[0], 2) for row in totals} == {round(totals[0][0], 2)}


def derived_tables(transactions):
    return {
        **gold.account_tables(gold.account_subtotals(transactions)),
        **gold.daily_tables(gold.daily_subtotals(transactions)),
    }


def test_tables_from_subtotals_equal_the_direct_tables(transactions):
    derived = derived_tables(transactions)
    assert len(derived) == 5
    for name, df in derived.items():
        direct = getattr(gold, name)(transactions)
        assert shape(df.schema) == shape(direct.schema)
        assert values(df) == values(direct)


def test_an_amount_free_group_has_no_total(rows):
    frame = rows(SILVER["transactions"], ("t", "a", "X", None, "USD", None, "d"))
    for df in (gold.fact_transaction_type(frame), derived_tables(frame)["fact_transaction_type"]):
        assert values(df) == Counter({("X", None, None, 1): 1})


def test_preview_is_the_smallest_keys(transactions):
    ids = [r.Transaction_ID for r in gold.preview(transactions, "Transaction_ID").collect()]
    every = sorted(r.Transaction_ID for r in transactions.select("Transaction_ID").collect())
    assert ids == every[:10]


def test_star_keeps_every_transaction_also_with_hot_keys(spark, transactions):
    accounts = gold.dim_account(silver.silver_accounts(sample.bronze_accounts(spark, SF)))
    customers = gold.dim_customer(
        silver.silver_customers(sample.bronze_customers(spark, SF)), LOADED_AT
    )
    plain = star_transactions(transactions, accounts, customers)
    hot = star_transactions(transactions, accounts, customers, max_parts=500, min_part_rows=3)
    assert plain.count() == transactions.count()
    assert values(plain) == values(hot)


@pytest.fixture
def star_sides(spark, transactions):
    accounts = gold.dim_account(silver.silver_accounts(sample.bronze_accounts(spark, SF)))
    customers = gold.dim_customer(silver.silver_customers(sample.bronze_customers(spark, SF)), LOADED_AT)
    return transactions, accounts, customers


@pytest.fixture
def shuffled_joins(spark):
    """No side is small enough to be broadcast by Spark itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limits", [{}, {"max_parts": 500, "min_part_rows": 3}])
def test_a_bucketed_star_is_read_without_a_shuffle(spark, star_sides, shuffled_joins, tmp_path, limits):
    tables = StarTables(spark, str(tmp_path), buckets=4)
    for _ in range(2):  # written again, the tables are replaced
        tables.write(*star_sides, **limits)
    star = tables.read()
    assert values(star) == values(star_transactions(*star_sides))
    plan = plan_text(star)
    assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
    assert plan.split("== Initial Plan ==")[0].count("SelectedBucketsCount: 4 out of 4") == 2
    some = tables.read(F.col("Currency") == "USD")
    assert "EqualTo(Currency,USD)" in plan_text(some)
    assert values(some) == values(star.filter("Currency = 'USD'"))


def test_a_hot_account_is_split_over_buckets(spark, tmp_path):
    """Two thirds of the transactions, all alike, are of one account; others have none or an unknown one."""
    ids = [("hot", 6000), ("b", 2000), ("unknown", 500), (None, 500)]
    facts = None
    for account, n in ids:
        part = spark.range(0, n, 1, 16).select(
            F.lit("t").alias("Transaction_ID"), F.lit(account).cast("string").alias("Account_ID"), F.lit("x").alias("Transaction_Type"),
            F.lit(1.0).cast("float").alias("Amount"), F.lit("USD").alias("Currency"), F.lit("d").alias("Description"), F.lit("2024-01-01").alias("Transaction_Date"),
        )
        facts = part if facts is None else facts.union(part)
    accounts = spark.createDataFrame([("hot", "c", "s", "active", "LOW"), ("b", "c", "s", "active", "HIGH")], "account_id string, customer_id string, account_type string, status string, risk_level string")
    customers = spark.createDataFrame([("c", "N", "C", "L")], "Customer_ID string, Full_Name string, City string, Country string")
    tables = StarTables(spark, str(tmp_path), buckets=16)
    tables.write(facts, accounts, customers, max_parts=200, min_part_rows=200)
    counts = Counter({r.risk_level: r["count"] for r in tables.read().groupBy("risk_level").count().collect()})
    assert counts == {"LOW": 6000, "HIGH": 2000, None: 1000}
    largest = spark.table(f"{tables.name}_facts").groupBy(F.expr("input_file_name()")).count().agg(F.max("count")).first()[0]
    assert largest < 6000 / 2


@pytest.mark.parametrize("owners", ["risk_level = 'HIGH'", "City is not null and risk_level <> 'LOW'", "City is null", "false", "cast(null as boolean)"])
def test_a_star_of_some_owners(star_sides, owners):
    star = star_transactions(*star_sides)
    # An account that exists has a risk level.
    expected = values(star.filter("risk_level is not null").filter(owners))
    assert values(star_of_owners(*star_sides, F.expr(owners))) == expected
    assert star_of_owners(*star_sides, F.expr(owners)).columns[-len(OWNED):] == list(OWNED)


def test_few_facts_of_other_keys_reach_the_join(spark):
    facts = spark.range(100_000).select(F.col("id").cast("string").alias("k"))
    keys = facts.filter("cast(k as int) % 100 = 7").unionAll(spark.sql("SELECT cast(null AS string)"))
    near = may_be_among(facts.unionAll(spark.sql("SELECT cast(null AS string)")), keys, "k")
    assert near.join(keys, "k").count() == 1000
    assert near.count() < 1000 + 0.05 * 100_000
    assert may_be_among(facts, keys.limit(0), "k").count() == 0
    # A filter that is too small lets more pass, and loses none.
    full = may_be_among(facts, keys, "k", max_bytes=64)
    assert near.count() < full.count() and full.join(keys, "k").count() == 1000
    assert [filter_words(n, 1 << 20) for n in (0, 7, 8, 1000, 10**9)] == [1, 1, 2, 128, 1 << 17]
    with pytest.raises(TypeError):
        may_be_among(facts, spark.range(3).withColumnRenamed("id", "k"), "k")


# --- refresh ---------------------------------------------------------------------------------

GOLD_SCHEMAS = {
    "dim_account": "account_id customer_id account_type currency created_at status risk_level",
    "dim_branch": "branch_id branch_name address city country_region opened_on_clean",
    "dim_transaction": "Transaction_ID Account_ID Transaction_Type Currency Description "
    "transaction_ts",
    "dim_account_transaction_type": "Account_ID Transaction_Type Currency",
    "dim_customer": "Customer_ID Full_Name Email City Country Phone_Number Address_Line1 "
    "Address_Line2 State Postal_Code record_created_date is_active source_system",
}


def test_refresh_twice(spark, tmp_path):
    lake = refresh.Lakehouse(
        spark, *(str(tmp_path / layer) for layer in ("bronze", "silver", "gold")),
        as_of=AS_OF, loaded_at=LOADED_AT,
    )
    for entity, build in sample.BRONZE_TABLES.items():
        write_table(build(spark, SF), lake.bronze, entity)

    def tables():
        refresh.run_all(lake)
        return {name: values(read_table(spark, lake.gold, name)) for name in refresh.GOLD_TABLES}

    first = tables()
    assert len(first) == 16 and all(first.values())
    assert tables() == first
    for name, columns in GOLD_SCHEMAS.items():
        assert read_table(spark, lake.gold, name).columns == columns.split()
    for entity, schema in SILVER.items():
        assert shape(read_table(spark, lake.silver, entity).schema) == shape(schema)


def test_refresh_reports_a_missing_table(spark, tmp_path):
    lake = refresh.Lakehouse(
        spark, *(str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    )
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        refresh.run_all(lake)


def test_account_body_is_the_silver_schema_before_times():
    assert ACCOUNT_BODY.names == SILVER["accounts"].names
