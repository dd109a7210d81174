"""Events that were sent more than once land once (D4 on the landing stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def drop_resent(events: DataFrame, keys: Sequence[str] = ("event_id",), sent_at: str = "sent_at", within: str = "1 day") -> DataFrame:
    """The stream without events whose ``keys`` were seen at most ``within`` before, across batches and restarts.

    ``sent_at`` is the time of the event, a TIMESTAMP. The state holds a key until the watermark, the greatest
    time seen less ``within``, has passed it by ``within``: it is bounded by the events of that span, whatever
    the stream has carried. An event that comes later than the watermark is dropped, and the progress
    of the query counts it (``numRowsDroppedByWatermark``). NULL keys are one key; events without a time are
    as old as can be and dropped. Of copies that differ in other columns any one stays.
    """
    return events.withWatermark(sent_at, within).dropDuplicatesWithinWatermark(list(keys))
