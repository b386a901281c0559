"""Connected components by union-find.

Each partition first contracts its edges with a union-find forest of its own. What is left is
brought to stars by alternating two steps: every node hooks its larger neighbours, then its
smaller ones, to the smallest node it knows. Both are a map-side combined minimum and an
equi-join. Edges live in tables of the shared folder between rounds; none reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewarden.llm.common import stage

EDGE = "u bigint, v bigint"


def _forest(batches):
    """Edges of a partition as (node, root of its tree), the root being the smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def out():
        pairs = np.array([(x, root(x)) for x in list(parent)], np.int64).reshape(-1, 2)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = root(a), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > 2_000_000:  # a larger forest is handed on in parts
            yield out()
    if parent:
        yield out()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component_id`` of every node of ``edges`` (``u``, ``v``) that is not its component's smallest node."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    edges = stage(edges.mapInArrow(_forest, EDGE).distinct(), "edges")
    mark = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = edges.agg(mark.alias("x")).first()[0]
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        now = edges.agg(mark.alias("x")).first()[0]
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
        before = now
