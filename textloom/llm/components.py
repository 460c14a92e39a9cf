"""Connected components of a link table, as Spark joins; the label of a node is the smallest node it reaches."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

FOREST_LINKS = 1 << 18


def _local_roots(edges: DataFrame) -> DataFrame:
    """The links of each task replaced by links to the smallest node they reach there (for ``FOREST_LINKS`` at a time).

    This shortens chains before the first shuffle; the components stay the same.
    """

    def run(batches):
        root: dict[int, int] = {}

        def find(x):
            top = x
            while root.get(top, top) != top:
                top = root[top]
            while root.get(x, x) != top:
                root[x], x = top, root[x]
            return top

        def forest():
            pairs = [(x, find(x)) for x in root]
            return pa.RecordBatch.from_arrays([pa.array([x for x, r in pairs if x != r], pa.int64()), pa.array([r for x, r in pairs if x != r], pa.int64())], names=["a", "b"])

        for b in batches:
            for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
                x, y = find(x), find(y)
                if x != y:
                    low, high = min(x, y), max(x, y)
                    root[high] = low
                    root.setdefault(low, low)
            if len(root) > FOREST_LINKS:
                yield forest()
                root = {}
        yield forest()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node points its larger (or else its smaller) neighbours and itself at its smallest neighbour."""
    forward = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = forward.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else forward
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one link at most, and to a node that has none: all links go from nodes to their roots."""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("b").alias("u"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("u").agg(F.sum("down").alias("d"), F.max("up").alias("p")).filter("d > 1 OR (d = 1 AND p = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node of ``edges(a, b)``: alternating large and small stars.

    The neighbours of a node are never gathered: its smallest one is a partial aggregate, and
    the join back on a node with very many links is one that Spark splits. A round writes its
    links to the shared folder; the rounds grow with the logarithm of the longest chain. So few links that one task's forest holds them
    (``FOREST_LINKS``) are settled by that forest.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    start = _local_roots(edges.coalesce(1) if edges.limit(FOREST_LINKS + 1).count() <= FOREST_LINKS else edges)
    now = materialize(start.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        if _settled(now):
            break
        now = materialize(_star(_star(now, True), False), "links")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
