"""Connected components by local forests and star steps.

A task replaces the edges it holds by a spanning forest of them, in which every
node points to the smallest node it reaches; that is exact, and most edges of a
group of copies leave there.  Between two such steps a large star moves every
node's greater neighbours to the smallest one.  No component is ever gathered
in one place: the centre of a star is a hot join key, whose partitions
adaptive execution splits, and minima are aggregated before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import default_partitions, drop_written, giving_back, written

#: Edges that a task joins at once; what exceeds them makes a forest of its own.
EDGES = 1 << 21
#: Edges to a partition of a round, about: few large forests settle in fewer rounds than many small ones.
DEALT = 1 << 17


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that is not the smallest of its component, and that smallest node."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(names))
    while True:
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            break
        # Hook each root below its smallest neighbour, then flatten.
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    below = np.flatnonzero(root != np.arange(len(names)))
    return names[below], names[root[below]]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    us, vs, n = [], [], 0

    def out() -> pa.RecordBatch:
        child, parent = forest(np.concatenate(us), np.concatenate(vs))
        return pa.record_batch([pa.array(child, pa.int64()), pa.array(parent, pa.int64())], names=["u", "v"])

    for b in batches:
        us.append(b.column("u").to_numpy())
        vs.append(b.column("v").to_numpy())
        n += b.num_rows
        if n >= EDGES:
            made = out()
            yield made
            us, vs, n = [], [], 0
    if n:
        yield out()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # A merge join is one whose hot keys can be split; nothing is sent to the driver.
    moved = both.where("v > u").hint("merge").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v")


def partitions_for(edges: int, most: int) -> int:
    """Partitions that a round's edges are dealt to; never a single one."""
    return max(1, min(most, max(2, -(-edges // DEALT))))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) edges of longs -> (node, root) for every node that has an edge; the root is the smallest node."""
    spark = edges.sparkSession
    n = default_partitions(spark)

    def step(e: DataFrame, n: int) -> tuple[DataFrame, str, tuple]:
        dealt = e.repartition(n, "u").mapInArrow(giving_back(_forests), "u long, v long")
        seen = Observation()
        table, path = written(dealt.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")),
                              "components")
        got = seen.get
        return table, path, (got.get("n"), got.get("h"))

    e, path, before = step(edges.select("u", "v").where("u <> v"), n)
    # Without edges, or in one partition, the forest is final.
    for _ in range(max_rounds if before[0] else 0):
        e, new, now = step(_large_star(e), partitions_for(before[0], n))
        drop_written(spark, path)
        path = new
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
