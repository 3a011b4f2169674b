"""Connected components by hooking and contraction, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._session import drop, keep

#: So few edges are united in one task, which saves the last rounds.
LAST_EDGES = 16_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges(a, b); component is the smallest node reachable.

    Each round every node hooks to its smallest neighbour, paths are halved twice, and the edges are
    contracted to the new roots, so a star of any size takes one round. A hot node is aggregated
    before the shuffle (min, distinct); joins on it are left to adaptive skew handling. Nulls and
    self-loops are ignored; an empty table gives an empty one.
    """
    spark = edges.sparkSession
    edges = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    labels = None
    while (n := edges.count()) > 0:
        last = n <= LAST_EDGES
        if last:
            parent = keep(edges.repartition(1).mapInArrow(_union_find, "node long, up long"))
        else:
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            parent = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up"))
            for _ in range(2):
                upper = parent.select(F.col("node").alias("up"), F.col("up").alias("upper"))
                parent = parent.join(upper, "up", "left").select("node", F.coalesce("upper", "up").alias("up"))
            parent = keep(parent)
        old = [edges, parent]
        if labels is None:
            labels = keep(parent.select("node", F.col("up").alias("component")))
        else:
            old.append(labels)
            up = parent.select(F.col("node").alias("component"), "up")
            labels = keep(labels.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component")))
        if last:
            drop(spark, *old)
            break
        pa = parent.select(F.col("node").alias("a"), F.col("up").alias("x"))
        pb = parent.select(F.col("node").alias("b"), F.col("up").alias("y"))
        joined = edges.join(pa, "a", "left").join(pb, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
        edges = keep(joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
        drop(spark, *old)
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels


def _union_find(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
    up: dict[int, int] = {}

    def root(i: int) -> int:
        while up.setdefault(i, i) != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((root(a), root(b)))
            up[high] = low
    yield pyarrow.RecordBatch.from_arrays([pyarrow.array(list(up), pyarrow.int64()), pyarrow.array([root(i) for i in up], pyarrow.int64())], ["node", "up"])
