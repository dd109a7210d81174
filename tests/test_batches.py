"""Batches that are copied, counted and replaced in place: ledger, flags and days."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tributary.plans import silver
from tributary.plans.daily import DailyFact
from tributary.plans.gold import fact_transaction_daily
from tributary.schemas import BRONZE
from tributary.sources import copy_new_batches, read_copied, sample
from tributary.streaming import landing_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("step", ["cleared", *(f"copied {t}" for t in BRONZE), "entered"])
def test_a_copy_that_dies_after_any_step_loses_and_doubles_nothing(spark, tmp_path, step):
    landing, bronze, events = f"{tmp_path}/landing", f"{tmp_path}/bronze", sample.events(spark, SF)

    def land(batch):
        rows = landing_rows(sample.slice_of(events, batch, 3))
        rows.write.mode("overwrite").partitionBy("target").parquet(f"{landing}/batch={batch}")

    def die(reached):
        if reached == step:
            raise RuntimeError("killed")

    land(0)
    assert copy_new_batches(spark, landing, bronze) == [0]
    land(1)
    with pytest.raises(RuntimeError):
        copy_new_batches(spark, landing, bronze, reached=die)
    # Another batch has landed before the copy is run again.
    land(2)
    assert copy_new_batches(spark, landing, bronze) == ([2] if step == "entered" else [1, 2])
    assert copy_new_batches(spark, landing, bronze) == []
    whole = landing_rows(events)
    for table in BRONZE:
        expected = whole.where(F.col("target") == table)
        columns = [c for c in BRONZE[table].names if c in whole.columns]
        found = read_copied(spark, bronze, table)
        assert found.columns == BRONZE[table].names
        assert Counter(found.select(columns).collect()) == Counter(expected.select(columns).collect())


def test_a_copy_reads_new_batches_only(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    for batch in range(2):
        rows = landing_rows(sample.slice_of(sample.events(spark, SF), batch, 2))
        rows.write.partitionBy("target").parquet(f"{landing}/batch={batch}")
        copy_new_batches(spark, landing, f"{tmp_path}/bronze")
        for file in Path(f"{landing}/batch={batch}").rglob("*.parquet"):
            file.write_bytes(b"gone")  # a second look would fail
    assert read_copied(spark, f"{tmp_path}/bronze", "accounts").count() > 0
    assert read_copied(spark, f"{tmp_path}/nothing", "accounts").columns == BRONZE["accounts"].names


def test_malformed_values_are_counted_without_another_scan(spark, tmp_path):
    for entity, build in sample.BRONZE_TABLES.items():
        build(spark, SF).write.parquet(f"{tmp_path}/{entity}")
        bronze = spark.read.schema(BRONZE[entity]).parquet(f"{tmp_path}/{entity}")
        make, found = silver.SILVER_TABLES[entity], Observation(entity)
        flagged, plain = make(bronze, flags=found), make(bronze)
        scans = [df._jdf.queryExecution().executedPlan().toString().count("FileScan") for df in (flagged, plain)]
        assert scans == [1, 1]
        assert Counter(flagged.collect()) == Counter(plain.collect())
        assert found.get and all(n >= 0 for n in found.get.values())


def test_a_stream_reports_malformed_values(spark, tmp_path):
    sample.bronze_transactions(spark, SF).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(BRONZE["transactions"]).parquet(f"{tmp_path}/in")
    rows = silver.silver_transactions(stream, flags="transactions")
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    counts = [p.observedMetrics["transactions"] for p in query.recentProgress if p.observedMetrics]
    bronze = sample.bronze_transactions(spark, SF).where("transaction_id is not null and account_id is not null")
    assert sum(c["amount"] for c in counts) == bronze.where("amount = 'abc'").count() > 0
    assert sum(c["transaction_date"] for c in counts) == bronze.where("transaction_date = 'bad-date'").count()


def test_a_batch_replaces_its_days_and_no_others(spark, tmp_path):
    rows = silver.silver_transactions(sample.bronze_transactions(spark, SF)).cache()
    kept = DailyFact(spark, str(tmp_path))
    day = F.to_date("Transaction_Date")
    days = [r[0] for r in rows.where(day.isNotNull()).select(day).distinct().orderBy(day).limit(2).collect()]
    late = (day == F.lit(days[0])) | (day.isNull() & (F.col("Transaction_ID") > "TX-5"))

    def files():
        return {p.relative_to(tmp_path) for p in (tmp_path / "fact").rglob("*.parquet")}

    kept.add(rows.where(~F.coalesce(late, F.lit(False))), 0)
    before = files()
    kept.add(rows.where(late), 1)
    after = files()
    changed = {str(p.parent.name) for p in before ^ after}
    assert changed == {f"period={days[0]}", "period=none"} and len(before & after) >= len(before) - 2
    assert Counter(kept.table().collect()) == Counter(fact_transaction_daily(rows).collect())
    # A retried batch changes nothing.
    kept.add(rows.where(late), 1)
    assert Counter(kept.table().collect()) == Counter(fact_transaction_daily(rows).collect())
