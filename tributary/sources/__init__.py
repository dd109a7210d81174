"""Readers and writers."""

from tributary.sources.database import copy_tables, hash_predicates, jdbc_reader
from tributary.sources.files import complete_folders, delete_folder
from tributary.sources.ledger import copy_new_batches, read_copied
from tributary.sources.scratch import scratch_folder
from tributary.sources.tables import read_bronze, read_table, write_table

__all__ = [
    "complete_folders",
    "copy_new_batches",
    "copy_tables",
    "delete_folder",
    "hash_predicates",
    "jdbc_reader",
    "read_bronze",
    "read_copied",
    "read_table",
    "scratch_folder",
    "write_table",
]
