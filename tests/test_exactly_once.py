"""Landing exactly once: a sink that fails after each of its steps, and is run again."""

from __future__ import annotations

import json
import os
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException

from tributary.schemas import BRONZE, REJECTS
from tributary.sources import sample
from tributary.streaming import landing_table
from tributary.streaming.exactly_once import (
    FolderStore,
    LedgerWriter,
    Staged,
    delete_abandoned,
    read_landed_once,
    start_landing_once,
)

SF = "/root/testdata/sf0.001"
DRAIN = {"availableNow": True}


def die_once_at(step, marker):
    """Fails the first time that a step is reached, in whatever process."""

    def reached(done):
        if done == step and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError(f"killed when {done}")

    return reached


def stream(spark, folder):
    return spark.readStream.schema("topic string, body string").parquet(folder)


def contents(spark, landing):
    return {t: Counter(map(tuple, read_landed_once(spark, landing, t).collect())) for t in [*BRONZE, REJECTS]}


@pytest.mark.parametrize("step", ["staged", "looked up", "entered"])
def test_a_sink_that_fails_after_any_step_lands_every_event_once(spark, tmp_path, step):
    source, landing, marker = f"{tmp_path}/in", f"{tmp_path}/landing", f"{tmp_path}/died"
    events = sample.events(spark, SF).select("topic", "body")
    for number in range(3):
        sample.slice_of(events, number, 3).coalesce(3).write.mode("append").parquet(source)
        # The second batch is the one that dies.
        reached = die_once_at(step, marker) if number == 1 else lambda done: None
        query = start_landing_once(stream(spark, source), landing, trigger=DRAIN, reached=reached)
        if number == 1:
            with pytest.raises(StreamingQueryException, match="killed"):
                query.awaitTermination()
            start_landing_once(stream(spark, source), landing, trigger=DRAIN, reached=reached).awaitTermination()
        else:
            query.awaitTermination()
    expected = {t: Counter(map(tuple, landing_table(events, t).collect())) for t in [*BRONZE, REJECTS]}
    assert contents(spark, landing) == expected
    assert FolderStore(landing).last_entry() == 2
    delete_abandoned(spark, landing)
    assert contents(spark, landing) == expected
    assert delete_abandoned(spark, landing) == 0


def test_a_batch_whose_record_was_lost_is_dropped_when_it_comes_again(spark, tmp_path):
    source, landing = tmp_path / "in", tmp_path / "landing"
    spark.createDataFrame([("transactions-topic", json.dumps({"amount": 1}))], "topic string, body string").write.parquet(str(source))
    start_landing_once(stream(spark, str(source)), str(landing), trigger=DRAIN).awaitTermination()
    for record in ["0", ".0.crc"]:
        (landing / "_checkpoint" / "commits" / record).unlink(missing_ok=True)
    before = contents(spark, str(landing))
    start_landing_once(stream(spark, str(source)), str(landing), trigger=DRAIN).awaitTermination()
    assert contents(spark, str(landing)) == before
    assert sum(before["transactions"].values()) == 1
    assert delete_abandoned(spark, str(landing)) == 0


def test_nothing_is_there_before_the_first_batch(spark, tmp_path):
    assert read_landed_once(spark, str(tmp_path), "accounts").columns == BRONZE["accounts"].names
    assert delete_abandoned(spark, f"{tmp_path}/none") == 0
    assert FolderStore(f"{tmp_path}/none").last_entry() is None


def test_a_ledger_refuses_another_checkpoint(tmp_path):
    writer = LedgerWriter(FolderStore(str(tmp_path)), lambda step: None)
    for number in (0, 1):
        writer.commit([Staged([]), None], number)
    with pytest.raises(ValueError, match="another checkpoint"):
        writer.commit([Staged([])], 0)


def test_an_entered_batch_survives_its_abort(tmp_path):
    store = FolderStore(str(tmp_path))
    rows = pa.RecordBatch.from_pydict({"target": ["a"], "x": ["1"]})
    writer = LedgerWriter(store, lambda step: None)
    entered, lost = Staged(store.stage(iter([rows]))), Staged(store.stage(iter([rows])))
    writer.commit([entered], 0)
    writer.abort([entered, None], 0)
    writer.abort([lost], 1)
    assert [f"target=a/{f.name}" for f in tmp_path.rglob("*.parquet")] == entered.names


def test_a_task_that_fails_leaves_no_file(tmp_path):
    def batches():
        yield pa.RecordBatch.from_pydict({"target": ["a", "b"], "x": ["1", "2"]})
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        FolderStore(str(tmp_path)).stage(batches())
    assert list(tmp_path.rglob("*.parquet")) == []
