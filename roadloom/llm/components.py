"""Connected components of an edge table by alternating large-star and small-star steps.

A table of few edges is one task's work instead: the same rows, in one step rather than dozens.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Edges up to which one task joins them: two ids each, some 100 MB with what is kept of them.
FEW_EDGES = 300_000


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (u, v) rows; each keeps the components and pulls vertices to the smallest."""
    if large:
        near = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # from files, so that the join has a shuffle of its own and Spark can split a hub's many edges
    low = materialise(low, "low")
    joined = near.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(vertex, component) by union of the edges' vertices under the smallest."""
    kind = dict(edges.dtypes)["u"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def seen(x):
            parent.setdefault(x, x)
            return x

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        source = None
        for batch in batches:
            source = batch.schema.field(0).type
            for u, v in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                a, b = root(seen(u)), root(seen(v))
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if parent:
            vertices = list(parent)
            yield pa.record_batch({"vertex": pa.array(vertices, source), "component": pa.array([root(x) for x in vertices], source)})

    return edges.coalesce(1).mapInArrow(joined, f"vertex {kind}, component {kind}")


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(vertex, component) for every vertex with an edge; the component is its smallest vertex.

    ``edges`` has orderable columns u and v. Each round writes its edges to the shared scratch
    folder; only a count and a checksum come to the driver. The number of rounds grows with the
    logarithm of the component size; ``most_rounds`` raises rather than return unfinished work.
    """
    now = materialise(edges.where("u != v").select("u", "v").distinct(), "edges")
    if now.limit(FEW_EDGES + 1).count() <= FEW_EDGES:
        return materialise(_in_one_task(now), "components")
    mark = None
    for _ in range(most_rounds):
        sign = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == mark or sign[0] == 0:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
        mark = sign
        now = materialise(_step(_step(now, True), False), "edges")
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
