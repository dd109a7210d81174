"""Readers, writers and the snapshot copy.

The JDBC reader is checked for the calls it makes: reading through it takes a running database.
"""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from tributary.schemas import BRONZE
from tributary.sources import (
    copy_tables,
    hash_predicates,
    jdbc_reader,
    read_bronze,
    read_table,
    sample,
    scratch_folder,
    write_table,
)
from tributary.streaming import read_landing, start_landing

SF = "/root/testdata/sf0.001"


def test_bronze_has_its_fixed_schema_whatever_the_files_hold(spark, rows, tmp_path):
    write_table(rows("extra int, account_id string", (1, "a")), str(tmp_path), "accounts")
    bronze = read_bronze(spark, str(tmp_path), "accounts")
    assert bronze.schema == BRONZE["accounts"]
    assert [r.account_id for r in bronze.collect()] == ["a"]


@pytest.mark.parametrize("entity", sorted(sample.BRONZE_TABLES))
def test_sample_bronze_schema(spark, entity):
    assert sample.BRONZE_TABLES[entity](spark, SF).schema.names == BRONZE[entity].names


def test_tables_are_replaced_and_compressed(spark, rows, tmp_path):
    for n in (1, 2):
        write_table(rows("n int", (n,)), str(tmp_path), "t")
    assert [r.n for r in read_table(spark, str(tmp_path), "t").collect()] == [2]
    assert all("snappy" in f.name for f in (tmp_path / "t").glob("part-*"))


def test_landing_tables_are_copied_to_bronze(spark, tmp_path):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    start_landing(
        sample.event_files(spark, SF), landing, trigger={"availableNow": True}
    ).awaitTermination()
    for _ in range(2):
        copy_tables(lambda table: read_landing(spark, landing, table), bronze)
    for table in BRONZE:
        copied = read_bronze(spark, bronze, table)
        landed = read_landing(spark, landing, table)
        assert copied.count() == landed.count() > 0
        assert copied.exceptAll(landed).isEmpty()


def test_predicates_cover_every_row_once(rows):
    frame = rows("v int", *[(v,) for v in [None, 0, 1, 2, 3, 4, 5, 6]])
    parts = [[r.v for r in frame.filter(p).collect()] for p in hash_predicates("v % 3", 3)]
    assert parts == [[None, 0, 3, 6], [1, 4], [2, 5]]


def test_jdbc_reads_by_predicates():
    calls = []
    reader = SimpleNamespace(jdbc=lambda *args, **kw: calls.append((args, kw)))
    read = jdbc_reader(SimpleNamespace(read=reader), "jdbc:x", ["a = 0", "a = 1"], {"user": "u"})
    read("accounts")
    assert calls == [
        (
            ("jdbc:x", "accounts"),
            {"predicates": ["a = 0", "a = 1"], "properties": {"fetchsize": "10000", "queryTimeout": "7200", "user": "u"}},
        )
    ]


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_below_the_shared_folder():
    shared = session("yarn", **{"spark.checkpoint.dir": "hdfs:///scratch/"})
    one, two = scratch_folder(shared), scratch_folder(shared)
    assert one.startswith("hdfs:///scratch/tributary-") and one != two


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        scratch_folder(session("yarn"))


def test_a_local_session_may_use_a_local_folder(spark):
    assert scratch_folder(spark) != scratch_folder(spark)
