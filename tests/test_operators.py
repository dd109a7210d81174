"""Relational operators: results against a plain model, and the plans they need at scale."""

from __future__ import annotations

import io
import itertools
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.operators import (
    enrich,
    every_combination,
    explode_parquet_payloads,
    keep_latest,
    parse_json_text,
)

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def values(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


# --- keep_latest -----------------------------------------------------------------------------

versions = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from("abc")),
        st.one_of(st.none(), st.integers(0, 3)),
        st.one_of(st.none(), st.sampled_from("xyz")),
    ),
    max_size=30,
)


def newest(rows):
    """The greatest (t, v) per key, NULL being the smallest value."""
    best = {}
    for key, *rest in rows:
        rank = [(v is not None, v) for v in rest]
        if key not in best or rank > best[key][0]:
            best[key] = (rank, (key, *rest))
    return Counter(row for _, row in best.values())


@few
@given(versions)
def test_keep_latest_against_a_model(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, v string").repartition(4)
    once = keep_latest(df, ["k"], ["t"])
    assert values(once) == newest(rows)
    assert values(keep_latest(once, ["k"], ["t"])) == values(once)


def test_keep_latest_by_key_alone(rows):
    assert values(keep_latest(rows("k string", ("a",), ("a",), (None,), (None,)), ["k"])) == Counter(
        {("a",): 1, (None,): 1}
    )


def test_keep_latest_limits_each_key_before_the_shuffle(rows):
    plan = plan_of(keep_latest(rows("k string, t int", ("a", 1)), ["k"], ["t"]))
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


# --- parse_json_text -------------------------------------------------------------------------

BODY = StructType().add("account_id", "string").add("balance", "double")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"account_id":"A","balance":1.5}', ("A", 1.5)),
        ('{"account_id":"A","balance":"1.5"}', ("A", None)),
        ('{"account_id":"A","balance":"abc"}', ("A", None)),
        ("{'account_id':'A'}", ("A", None)),
        ('{"account_id":"A"} trailing', ("A", None)),
        ('{"account_id":"A","account_id":"B"}', ("B", None)),
        ('{"ACCOUNT_ID":"A"}', (None, None)),
        ('{"account_id":7}', ("7", None)),
        ('[{"account_id":"A"}]', (None, None)),
        ("null", (None, None)),
        ("not json", (None, None)),
        ("", (None, None)),
        (None, (None, None)),
    ],
)
def test_lenient_parse(rows, text, expected):
    assert [tuple(r) for r in parse_json_text(rows("t string", (text,)), "t", BODY).collect()] == [
        expected
    ]


def test_a_filter_on_a_field_does_not_parse_twice(rows):
    parsed = parse_json_text(rows("t string", ("{}",)), "t", BODY).filter("account_id is not null")
    assert plan_of(parsed).count("from_json") == 1


# --- every_combination -----------------------------------------------------------------------


@few
@given(st.integers(0, 5), st.integers(0, 3), st.integers(0, 4))
def test_combinations_are_the_product(spark, a, b, c):
    frames = [
        spark.createDataFrame([(i,) for i in range(n)], f"{name} int")
        for name, n in (("a", a), ("b", b), ("c", c))
    ]
    got = values(every_combination(frames[0], "a", frames[1:], buckets=4).select("a", "b", "c"))
    assert got == Counter(itertools.product(range(a), range(b), range(c)))


def test_combinations_keep_a_null_key_and_need_no_nested_loop(rows):
    days, other = rows("d date, n int", (None, 1)), rows("s string", ("x",), (None,))
    paired = every_combination(days, "d", [other])
    assert paired.count() == 2
    assert "NestedLoop" not in plan_of(paired) and "Cartesian" not in plan_of(paired)


# --- enrich ----------------------------------------------------------------------------------

keys = st.one_of(st.none(), st.sampled_from(["hot", "a", "b", "unknown"]))


@few
@given(st.lists(keys, max_size=25), st.integers(1, 6), st.integers(1, 20))
def test_enrich_equals_a_left_join(spark, found, min_part_rows, max_parts):
    facts = spark.createDataFrame([(k, i) for i, k in enumerate(found)], "k string, i int")
    dimension = spark.createDataFrame(
        [("hot", 1), ("a", 2), ("b", 3), (None, 4)], "k string, attribute int"
    )
    got = enrich(facts, dimension, "k", max_parts=max_parts, min_part_rows=min_part_rows)
    assert values(got) == values(facts.join(dimension, "k", "left"))


KINDS = [("int", "bigint"), ("bigint", "int"), ("string", "string"), ("int", "int"), ("int", "double")]


@pytest.mark.parametrize("kinds", KINDS)
def test_enrich_with_every_bucket_hot_equals_a_left_join(spark, kinds):
    facts = spark.range(1000).selectExpr(f"cast(id % 200 as {kinds[0]}) k", "id i")
    twice = spark.sql(f"SELECT cast(60 AS {kinds[1]}), 0L")
    dimension = spark.range(50, 300).selectExpr(f"cast(id as {kinds[1]}) k", "id a").union(twice)
    got = enrich(facts, dimension, "k", min_part_rows=1)
    assert values(got) == values(facts.join(dimension, "k", "left"))
    assert got.schema["k"].dataType == facts.schema["k"].dataType


def test_enrich_refuses_keys_of_unequal_kinds(spark):
    with pytest.raises(TypeError):
        enrich(spark.range(3), spark.sql("SELECT '1' AS id, 2 AS a"), "id")


@pytest.fixture
def plain_plans(spark):
    """Plans as written: no runtime re-planning and no automatic broadcasts."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("hot", [-1, None])
def test_a_hot_key_is_spread_over_tasks(spark, plain_plans, hot):
    """Two thirds of the rows are exact copies with one key, or with none."""
    rows = F.when(F.col("id") % 3 == 0, F.col("id"))
    facts = spark.range(0, 9000, 1, 16).select(F.coalesce(rows, F.lit(hot)).alias("k"))
    dimension = spark.range(-1, 9000).select(F.col("id").alias("k"), F.lit("x").alias("a"))
    df = enrich(facts, dimension, "k", max_parts=100, min_part_rows=500)
    assert df.filter("a is not null").count() == (9000 if hot else 3000)
    assert df.count() == 9000
    largest = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert largest < 6000 / 2


def test_only_the_few_hot_keys_are_broadcast(spark, plain_plans):
    facts = spark.range(100).withColumnRenamed("id", "k")
    plan = plan_of(enrich(facts, facts.withColumn("a", F.lit(1)), "k"))
    assert re.findall(r"(\w+Join) .*?(Left\w+|Inner)", plan) == [
        ("SortMergeJoin", "LeftOuter"),  # facts and dimension, by key and part,
        ("BroadcastHashJoin", "LeftOuter"),  # the facts with the parts of their keys,
        ("BroadcastHashJoin", "LeftOuter"),  # the dimension likewise
    ]


# --- payloads --------------------------------------------------------------------------------


def parquet(**columns) -> bytes:
    out = io.BytesIO()
    pq.write_table(pa.table(columns), out)
    return out.getvalue()


def test_payload_rows_become_text(rows):
    good = parquet(id=["a", None], amount=[1.5, None])
    got = explode_parquet_payloads(rows("p binary", (good,)), "p", ["id", "amount", "other"])
    assert values(got) == Counter({("a", "1.5", None, None): 1, (None, None, None, None): 1})


def test_unreadable_payloads_are_kept_whole(rows):
    good = parquet(id=["a"])
    broken = good[: len(good) // 2]
    unknown = parquet(id=["a"], zzz=[1])
    frame = rows("p binary", (b"junk",), (broken,), (unknown,), (b"",), (None,))
    got = values(explode_parquet_payloads(frame, "p", ["id"]))
    assert got == Counter(
        {(None, message): 1 for message in (b"junk", broken, unknown, b"")}
    )
