"""Numbered folders of a table that grows batch by batch, in whatever file system Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def folders(spark: SparkSession, root: str, key: str) -> list[int]:
    """The numbers n, in order, of folders ``<key>=<n>`` under ``root``."""
    system, place = _place(spark, root)
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]
    return sorted(int(n.partition("=")[2]) for n in names if n.partition("=")[0] == key)


def complete_folders(spark: SparkSession, root: str, key: str) -> list[int]:
    """Those of ``folders`` whose write was committed."""
    return [n for n in folders(spark, root, key) if exists(spark, f"{root}/{key}={n}/_SUCCESS")]


def delete_folder(spark: SparkSession, path: str) -> None:
    system, place = _place(spark, path)
    system.delete(place, True)
