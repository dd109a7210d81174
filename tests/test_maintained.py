"""Newest rows kept by a stream, facts maintained from changes, exact sums, and events that are sent again."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tributary.functions import exact_sum
from tributary.operators import keep_latest
from tributary.plans.maintain import Fact, Maintained, account_facts
from tributary.sources import complete_folders
from tributary.streaming import (
    current_rows,
    drop_resent,
    latest_changes,
    read_changes,
    start_changes,
    stateful_session,
)
from tributary.streaming.changes import BUCKETS, _newest_of_batch

ONCE = {"availableNow": True}
SCHEMA = "k string, at timestamp, x double, note string"


def plain(rows):
    return Counter(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows)


def versions(count, seed):
    pick = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (
            pick.choice(["a", "b", "é", "", None, "hot", "hot", "hot"]),
            pick.choice([None, start + timedelta(hours=pick.randint(0, 3))]),
            pick.choice([None, 1.5, -0.5, float("nan"), float("inf")]),
            pick.choice([None, "m", "z"]),
        )
        for _ in range(count)
    ]


@pytest.fixture
def feed(spark, tmp_path):
    """Writes rows as one more batch of the source of a stream."""

    def write(rows, schema=SCHEMA):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")

    return write


def run(spark, root, schema=SCHEMA, after=None, keys=("k",), newest_by=("at",)):
    stream = stateful_session(spark).readStream.schema(schema).parquet(f"{root}/in")
    start_changes(latest_changes(stream, keys, newest_by), str(root), ONCE, after).awaitTermination()


def test_changes_give_the_newest_rows(spark, feed, tmp_path):
    every = []
    for seed in range(4):
        rows = versions(12, seed)
        feed(rows)
        every += rows
        run(spark, tmp_path)
        changes = read_changes(spark, tmp_path, spark.createDataFrame([], SCHEMA).schema)
        expected = plain(keep_latest(spark.createDataFrame(every, SCHEMA), ["k"], ["at"]).collect())
        assert plain(current_rows(changes, ["k"]).collect()) == expected
    # Batch by batch: what is taken back stood before, and a key changes once.
    standing, found = Counter(), changes.collect()
    for batch in sorted({r.batch for r in found}):
        own = [r for r in found if r.batch == batch]
        assert len({r.new.k for r in own}) == len(own)
        old = plain(r.old for r in own if r.old is not None)
        assert not old - standing
        standing = standing - old + plain(r.new for r in own)
    assert standing == expected and len({r.batch for r in found}) > 1


def test_older_and_equal_rows_change_nothing(spark, feed, tmp_path):
    newest = ("a", datetime(2024, 1, 2), 1.0, "n")
    for rows in ([newest], [newest], [("a", datetime(2024, 1, 1), 9.0, "z"), ("a", None, 1.0, "n")]):
        feed(rows)
        run(spark, tmp_path)
    changes = read_changes(spark, tmp_path, spark.createDataFrame([], SCHEMA).schema)
    assert [(r.old, tuple(r.new)) for r in changes.collect()] == [(None, newest)]


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    rows = spark.createDataFrame(versions(400, 9), SCHEMA).coalesce(1)
    by = ["at", "x", "note"]
    kept = rows.mapInArrow(_newest_of_batch(["k"], by), rows.schema)
    assert plain(kept.collect()) == plain(keep_latest(rows, ["k"], ["at"]).collect())


def test_many_keys_share_state_and_calls(spark, feed, tmp_path):
    """Keys meet in buckets, so that neither state nor calls of Python are one a key; NULL, NaN and signed zeros are keys."""
    schema, keys = "k double, at timestamp, x double, note string", 3 * BUCKETS
    odd, every, states = [None, float("nan"), 0.0, -0.0], [], []
    for day in range(2):
        at = datetime(2024, 1, 1) + timedelta(days=day)
        rows = [(k, at, 1.0, "é") for k in odd] + [(float(k), at, None if k % 3 else float(day), None) for k in range(1 + day * keys // 2, keys)]
        feed(rows, schema)
        every += rows
        stream = stateful_session(spark).readStream.schema(schema).parquet(f"{tmp_path}/in")
        query = start_changes(latest_changes(stream, ["k"], ["at"]), str(tmp_path), ONCE)
        query.awaitTermination()
        states.append(query.recentProgress[-1].stateOperators[0].numRowsTotal)
    found = current_rows(read_changes(spark, tmp_path, spark.createDataFrame([], schema).schema), ["k"])
    expected = keep_latest(spark.createDataFrame(every, schema), ["k"], ["at"])
    assert plain(found.collect()) == plain(expected.collect())
    assert found.count() == keys + 2 and max(states) <= BUCKETS < keys


ACCOUNT = "account_id string, customer_id string, account_type string, balance double, currency string, created_at timestamp, status string"


def account_versions(seed):
    pick = random.Random(seed)
    return [
        (
            f"A{pick.randint(0, 9)}", "c", pick.choice(["S", "C", None]), pick.choice([None, 0.1, 0.2, 1e9, -0.3]),
            pick.choice(["USD", "EUR", None]), datetime(2024, 1, 1) + timedelta(hours=pick.randint(0, 60)), pick.choice(["active", None]),
        )
        for _ in range(30)
    ]


def tables_of(rows):
    """The four account facts of the rows, as dictionaries."""
    out = {name: {} for name in account_facts()}
    for kind, key, value in (("currency_balance", 4, 3), ("avg_balance_type", 2, 3)):
        for group in {r[key] for r in rows}:
            values = [r[value] for r in rows if r[key] == group and r[value] is not None]
            total = math.fsum(values)
            out[kind][group] = (total if kind == "currency_balance" else total / len(values)) if values else None
    out["status_counts"] = dict(Counter(r[6] for r in rows))
    out["daily_openings"] = dict(Counter(r[5].date() for r in rows))
    return out


def test_maintained_facts_follow_late_updates_and_retries(spark, feed, tmp_path):
    """After each batch as a recomputation gives them; a batch that fails half-way is run again; folding changes nothing."""
    kept, every, failing = Maintained(spark, f"{tmp_path}/facts", account_facts()), [], [True]

    def after(changes, batch_id):
        assert all(f"batch={batch_id}" in name for name in changes.inputFiles())
        kept.add(changes, batch_id)
        if failing:
            failing.clear()
            raise RuntimeError("lost")

    for seed in range(4):
        rows = account_versions(seed)
        feed(rows, ACCOUNT)
        every += rows
        for _ in range(2):
            try:
                run(spark, tmp_path, ACCOUNT, after, ("account_id",), ("created_at",))
                break
            except Exception as error:
                assert "lost" in str(error)
        if seed == 2:
            for name in kept.facts:
                kept.compact(name)
        latest = [tuple(r) for r in keep_latest(spark.createDataFrame(every, ACCOUNT), ["account_id"], ["created_at"]).collect()]
        assert {name: dict(map(tuple, kept.table(name).collect())) for name in kept.facts} == tables_of(latest)
    for name in kept.facts:
        kept.compact(name)
        assert complete_folders(spark, f"{tmp_path}/facts/{name}", "upto") == [2, 3]
        assert complete_folders(spark, f"{tmp_path}/facts/{name}", "batch") == [3]
    assert {name: dict(map(tuple, kept.table(name).collect())) for name in kept.facts} == tables_of(latest)


def test_maintained_facts_before_the_first_batch(spark, tmp_path):
    with pytest.raises(ValueError):
        Maintained(spark, str(tmp_path), account_facts()).table("status_counts")


def test_groups_that_lose_all_rows_are_gone(spark):
    fact = Fact({"g": F.col("g")}, {"n": F.col("rows")})
    changes = spark.createDataFrame(
        [(None, ("x",)), (("x",), ("y",)), (None, (None,))], "old struct<g: string>, new struct<g: string>"
    )
    assert {tuple(r) for r in fact.result(fact.deltas(changes)).collect()} == {("y", 1), (None, 1)}


def test_exact_sums_have_equal_bits_in_any_order(spark):
    pick = random.Random(1)
    values = [pick.choice([-1, 1]) * pick.random() * 10 ** pick.randint(-9, 12) for _ in range(2000)] + [None, 0.0, 1e-300, 2.0**62]
    df = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values)], "k int, v double")
    found = {tuple(sorted(map(tuple, df.repartition(n).groupBy("k").agg(exact_sum(F.col("v"))).collect()))) for n in range(1, 11)}
    expected = [math.fsum(v for k, v in enumerate(values) if k % 3 == g and v is not None) for g in range(3)]
    assert len(found) == 1 and [v for _, v in found.pop()] == expected


@pytest.mark.parametrize("values", [[-1e-20], [1.0, -1.0, -1e-20], [0.1] * 10, [-0.75, 0.5], [float("inf"), 1.0], [1e300, -1e300], []])
def test_exact_sums_of_odd_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(exact_sum(F.col("v"))).first()[0] == (math.fsum(values) if values else None)


def test_resent_events_land_once_and_the_state_stays_small(spark, tmp_path):
    schema, days, a_day = "event_id long, sent_at timestamp", 12, 50
    start, last = datetime(2024, 1, 1), None
    landed = f"{tmp_path}/out"
    for day in range(days):
        own = [(day * a_day + k, start + timedelta(days=day, minutes=k)) for k in range(a_day)]
        again = [(i - a_day, t - timedelta(days=1)) for i, t in own[::2]] if day else []
        spark.createDataFrame(own + again + own[:5], schema).repartition(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = drop_resent(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), within="2 days")
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(**ONCE).start(landed)
        query.awaitTermination()
        last = query.recentProgress[-1]
    assert Counter(r.event_id for r in spark.read.parquet(landed).collect()) == Counter(range(days * a_day))
    # Keys live until the watermark, two days behind, has passed them by two days.
    assert last.stateOperators[0].numRowsTotal <= 5 * a_day < days * a_day
