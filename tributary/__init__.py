"""Tributary: a layered lakehouse for banking event streams, built on Spark DataFrames.

Layers
------
streaming   events of four topics -> landing tables (Structured Streaming)
sources     readers, writers, database snapshots, sample inputs
plans       bronze -> silver -> gold, each step a ``DataFrame -> DataFrame`` function
operators   the few relational building blocks that are more than one Spark call
functions   ``Column -> Column`` expressions
"""
