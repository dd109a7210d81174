"""Connected components of a link table, by contraction: in each task first, then between tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.tables import Stage

#: Links that one task joins up by itself.
TOGETHER = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, label): each end of the task's links and the smallest that they connect it with."""
    above: dict[int, int] = {}

    def root(v: int) -> int:
        top = above.setdefault(v, v)
        while top != above[top]:
            top = above[top]
        while above[v] != top:
            above[v], v = top, above[v]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                above[max(a, b)] = min(a, b)
    ends = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array([root(v) for v in ends], pa.int64())], ["v", "label"])


def components(links: DataFrame, stage: Stage, name: str = "cc") -> DataFrame:
    """``links(a, b)`` between numbers -> ``(v, label)``: each end and the smallest of its component.

    Tasks join up what ``TOGETHER`` links each connect. While more than one task is needed, each vertex
    then takes the smallest label that any task gave to it or to a vertex under it, and links between equal
    labels go: every vertex that is not the smallest of its neighbours merges, so the rounds are about
    the logarithm of the largest component. All of them are written tables, and aggregates combine
    map-side, so a vertex with very many links is no hot task.
    """
    edges = stage.table(links.select("a", "b").where("a <> b").distinct(), f"{name}-edges0")
    maps: list[DataFrame] = []
    while True:
        turn, parts = len(maps), -(-max(edges.count(), 1) // TOGETHER)
        forest = stage.table(edges.repartition(parts).mapInArrow(_forest, "v long, label long"), f"{name}-forest{turn}")
        if parts == 1:
            maps.append(forest)
            break
        both = forest.union(forest.select("label", "v"))
        parent = stage.table(both.groupBy("v").agg(F.least("v", F.min("label")).alias("label")), f"{name}-parent{turn}")
        maps.append(stage.table(_relabelled(parent, "label", parent), f"{name}-map{turn}"))
        ends = forest.select(F.col("v").alias("a"), F.col("label").alias("b"))
        moved = _relabelled(_relabelled(ends, "a", maps[-1]), "b", maps[-1])
        edges = stage.table(moved.where("a <> b").distinct(), f"{name}-edges{turn + 1}")
    found = maps[0]
    for later in maps[1:]:
        found = _relabelled(found, "label", later)
    found = stage.table(found, f"{name}-found") if len(maps) > 1 else found
    stage.drop(f"{name}-edges", f"{name}-parent", f"{name}-map", *([f"{name}-forest"] if len(maps) > 1 else []))
    return found


def _relabelled(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``column`` replaced by the label that it has."""
    new = labels.select(F.col("v").alias(column), F.col("label").alias("relabelled"))
    joined = rows.join(new, column, "left").withColumn(column, F.coalesce("relabelled", column))
    return joined.select(*rows.columns)
