"""From event topics to landing tables."""

from tributary.streaming.changes import (
    current_rows,
    latest_changes,
    read_changes,
    start_changes,
    stateful_session,
)
from tributary.streaming.dedup import drop_resent
from tributary.streaming.envelope import landing_rows, landing_table, visible_events
from tributary.streaming.exactly_once import (
    FolderStore,
    delete_abandoned,
    read_landed_once,
    start_landing_once,
)
from tributary.streaming.landing import (
    database_sink,
    event_stream,
    create_landing,
    folder_sink,
    read_landing,
    start_landing,
)

__all__ = [
    "FolderStore",
    "create_landing",
    "current_rows",
    "database_sink",
    "delete_abandoned",
    "drop_resent",
    "event_stream",
    "folder_sink",
    "landing_rows",
    "landing_table",
    "latest_changes",
    "read_changes",
    "read_landed_once",
    "read_landing",
    "start_changes",
    "start_landing",
    "start_landing_once",
    "stateful_session",
    "visible_events",
]
