"""Connected components of an undirected edge table, as joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint
from .joins import lookup_join


#: Nodes a task holds while it reduces links; beyond that it passes on what it has.
FOREST_NODES = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars: every node linked to the least node it
    is connected to among at most ``FOREST_NODES`` nodes held at a time."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def stars() -> Iterator[pa.RecordBatch]:
        nodes = [x for x in parent if find(x) != x]
        if nodes:
            yield pa.RecordBatch.from_pydict({"u": pa.array(nodes, pa.int64()),
                                              "v": pa.array([find(x) for x in nodes], pa.int64())})
        parent.clear()

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            u, v = find(u), find(v)
            parent[max(u, v)] = min(u, v)
        if len(parent) > FOREST_NODES:
            yield from stars()
    yield from stars()


def _spokes(edges: DataFrame) -> DataFrame:
    """Link every node's neighbours to the least node around it (a neighbour or itself)."""
    around = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return lookup_join(edges, checkpoint(around), ["u"], "inner")


def _settled(down: DataFrame) -> bool:
    """Whether all links are stars: no node has two roots, no root has a root."""
    return (down.groupBy("u").count().filter("count > 1").isEmpty()
            and down.join(down.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between longs → (node, root): the least node of the component,
    for every node that has a link to another and isn't itself the root.

    Partitions first reduce their own links to stars. Alternating large and small
    stars then join these: every round replaces links by links to the least node
    known nearby, so their number never grows and the rounds grow with the
    logarithm of the longest path. Each round is written to the checkpoint
    folder. It ends when only stars are left.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    down = checkpoint(down.mapInArrow(_forest, "u bigint, v bigint"))
    while not _settled(down):
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _spokes(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = _spokes(checkpoint(large))
        down = checkpoint(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    return down.select(F.col("u").alias("node"), F.col("v").alias("root"))
