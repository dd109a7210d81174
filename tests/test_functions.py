"""Edge rows of the column expressions (FIXTURES.md 4)."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary import functions as fn


@pytest.fixture
def apply(rows):
    """Values of an expression over a text column, in input order."""

    def run(expression, *values, schema="v string"):
        frame = rows(f"i int, {schema}", *[(i, v) for i, v in enumerate(values)])
        out = frame.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()
        return [row.o for row in out]

    return run


def test_blank_bodies(apply):
    kept = apply(fn.not_blank, "", " \t\n", " ", "　", "\x1c\x1f", " x ", "0", None)
    assert kept == [False, False, False, False, False, True, True, None]


def test_json_shape_is_one_line(apply):
    assert apply(fn.looks_like_json_object, '{"a":1}', ' {} ', '{"a":\n1}', "x", None) == [
        True, True, False, False, None,
    ]


def test_phone_keeps_digits(apply):
    assert apply(fn.digits_only, "+1 (555) 000-7", "x12", "", None) == ["15550007", "12", "", None]


def test_full_name_needs_both_parts(rows):
    frame = rows("a string, b string", ("Ann", "Lee"), ("Ann", None), (None, "Lee"))
    names = frame.select(fn.full_name(F.col("a"), F.col("b")).alias("n")).collect()
    assert [r.n for r in names] == ["Ann Lee", None, None]


def test_timestamp_format(apply):
    good = "2024-01-02 03:04:05"
    assert apply(fn.parse_timestamp, good, "xx", "2024-01-02", "2024-13-01 00:00:00", "", None) == [
        datetime(2024, 1, 2, 3, 4, 5), None, None, None, None, None,
    ]


digits = st.integers(0, 99).map("{:02d}".format)
stamps = st.tuples(st.integers(0, 9999), digits, digits, digits, digits, digits).map(
    lambda p: "{:04d}-{}-{} {}:{}:{}".format(*p)
)
likely = st.datetimes(datetime(1800, 1, 1), datetime(2100, 1, 1)).map("{:%Y-%m-%d %H:%M:%S}".format)
odd = st.tuples(likely, st.sampled_from(["\n", " ", "Z", ".1", "+01:00", "٣"])).map("".join)
signed = likely.map(lambda text: "+1" + text)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.one_of(stamps, likely, odd, signed), min_size=50, max_size=300))
def test_timestamps_are_read_as_the_formatter_reads_them(spark, zone, texts):
    edges = ["0000-01-01 00:00:00", "2024-02-29 23:59:59", "2023-02-29 00:00:00",
             "2024-03-10 02:30:00", "2024-11-03 01:30:00", "2024-01-01 24:00:00",
             "2024-01-01 00:00:60", "1582-10-10 00:00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in texts + edges], "v string")
        formatted = F.try_to_timestamp("v", F.lit("yyyy-MM-dd HH:mm:ss"))
        other = frame.filter(~fn.parse_timestamp(F.col("v")).eqNullSafe(formatted))
        assert [r.v for r in other.collect()] == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_timestamp_conversion_is_identity_on_timestamps(rows):
    stamp = datetime(2024, 1, 2, 3, 4, 5)
    frame = rows("v timestamp", (stamp,), (None,)).select(fn.to_timestamp(F.col("v")).alias("o"))
    assert [r.o for r in frame.collect()] == [stamp, None]


def test_float_is_32_bit(apply):
    got = apply(lambda v: fn.parse_float(v).cast("double"), "abc", " 12.5 ", "0.1", "", None)
    assert got[0] is None and got[1] == 12.5 and got[3] is None and got[4] is None
    assert got[2] == pytest.approx(0.10000000149, abs=1e-12) and got[2] != 0.1


def test_date_parse(apply):
    assert apply(fn.parse_date, "2024-02-30", "2024-02-03", "unknown", None) == [
        None, date(2024, 2, 3), None, None,
    ]


def test_age_counts_days_to_the_given_date(rows):
    frame = rows("v date", (date(2025, 12, 30),), (None,))
    ages = frame.select(fn.age_in_days(F.col("v"), date(2026, 1, 1)).alias("o")).collect()
    assert [r.o for r in ages] == [2, None]
    today = frame.select(fn.age_in_days(F.current_date()).alias("o")).first()
    assert today.o == 0


def test_active_flag_and_risk(apply):
    statuses = ["active", "inactive", "blocked", "Active", "", None]
    assert apply(fn.active_flag, *statuses) == [1, 0, 0, 0, 0, 0]
    assert apply(fn.risk_level, *statuses) == ["LOW", "MEDIUM", "HIGH", "LOW", "LOW", "LOW"]


def test_usd_value(apply):
    usd = apply(lambda c: fn.usd_value(F.lit(100.0), c), "USD", "EUR", "PKR", "GBP", "usd", None)
    assert usd == [100.0, 100.0 * 1.08, 100.0 * 0.0036, None, None, None]


def test_country_default(apply):
    assert apply(fn.country_or_unknown, None, "", "PK") == ["Unknown", "", "PK"]


def test_trim_strips_spaces_only(apply):
    assert apply(fn.trimmed, "  a ", "\ta\n", None) == ["a", "\ta\n", None]


def test_commas_become_dashes(apply):
    assert apply(fn.dashes_for_commas, "1, High St, B", "", None) == ["1- High St- B", "", None]


def test_address_lines(apply):
    values = ["one", "one\ntwo", "one\ntwo\nthree", "", None]
    assert apply(lambda v: fn.address_line(v, 0), *values) == ["one", "one", "one", "", None]
    assert apply(lambda v: fn.address_line(v, 1), *values) == [None, "two", "two", None, None]


def test_state_and_zip(apply):
    values = ["Foo, CA 90210", "abc", "Foo, ca 90210-1234", None]
    assert apply(fn.state_code, *values) == ["CA", "", "", None]
    assert apply(fn.postal_code, *values) == ["90210", "", "", None]
