"""Connected components of an edge table.

Up to ``few`` edges (a stated bound, some 100 MB of a task's memory) one task joins them; beyond it alternating
large-star and small-star steps do. Nodes are of any one orderable type. Each round of steps is cut with a checkpoint in
the shared folder, so that lost executors cost a round at most, and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import cut


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _star(pairs: DataFrame) -> DataFrame:
    """Each of a node's neighbours is tied to the least of the node and its neighbours."""
    least = _minima(pairs).withColumn("m", F.least("u", "m"))
    return pairs.join(least, "u").select("u", "v", "m")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    return _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small(edges: DataFrame) -> DataFrame:
    tied = _star(edges)  # every edge runs from the larger node u to the smaller node v
    out = tied.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(tied.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges (a, b) -> node, component, by union-find."""
    root: dict = {}

    def find(k):
        while (up := root.setdefault(k, k)) != k:
            root[k] = k = root[up]
        return k

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    if kind is not None:
        nodes = list(root)
        for low in range(0, len(nodes), 50_000):
            part = nodes[low : low + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, kind), pa.array([find(k) for k in part], kind)], names=["node", "component"])


def components(edges: DataFrame, few: int = 500_000, most_rounds: int = 60) -> DataFrame:
    """edges(a, b) -> node, component: the least node of its component, for every node that has an edge to another.

    The edges are read twice and should be materialised.
    """
    if edges.count() <= few:
        kind = edges.schema[0].dataType.simpleString()
        return cut(edges.where("a != b").select("a", "b").coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}"))
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now = cut(now)
    state = None
    for _ in range(most_rounds):
        now = cut(_small(_large(now)))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        state = tuple(seen)
    raise RuntimeError("the components did not settle")
