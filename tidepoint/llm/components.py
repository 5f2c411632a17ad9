"""Connected components by contraction, as DataFrame joins.

In each round every node takes the neighbour (or itself) with the least random priority, and
the edges are rewritten to those. Random priorities shrink chains as well as stars, so the
rounds grow with the logarithm of the input. Edges are distinct pairs and are aggregated
before they move; a node with very many neighbours is combined map-side. Once a count shows
that at most ``SMALL_EDGES`` edges are left, 16 bytes each, one task joins those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepoint.session import pin

SMALL_EDGES = 1_000_000


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, root`` of all nodes of a bounded list of edges."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not parts:
        return
    a, b = (np.concatenate(c) for c in zip(*parts))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = index[: len(a)], index[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "root"])


def _contracted(edges: DataFrame, step: int) -> DataFrame:
    """``node, root``: the neighbour of least priority of every node."""
    priority = F.xxhash64("node", F.lit(step))
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
    )
    best = F.min(F.struct(F.xxhash64("near", F.lit(step)).alias("p"), F.col("near")))
    picked = both.groupBy("node").agg(best.alias("best"))
    own = F.struct(priority.alias("p"), F.col("node").alias("near"))
    return picked.select("node", F.least("best", own)["near"].alias("root"))


def components(edges: DataFrame, small_edges: int = SMALL_EDGES) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; component is its least node."""
    edges = pin(edges.select("a", "b").where("a <> b").distinct())
    roots, step, left = None, 0, edges.count()
    while left:
        if left <= small_edges:
            chosen = pin(edges.repartition(1).mapInArrow(_join_up, "node bigint, root bigint"))
            left = 0
        else:
            chosen = pin(_contracted(edges, step))
            of_a = chosen.select(F.col("node").alias("a"), F.col("root").alias("ra"))
            of_b = chosen.select(F.col("node").alias("b"), F.col("root").alias("rb"))
            edges = pin(
                edges.join(of_a, "a")
                .join(of_b, "b")
                .where("ra <> rb")
                .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                .distinct()
            )
            left = edges.count()
        if roots is None:
            roots = chosen
        else:
            onward = chosen.select(F.col("node").alias("root"), F.col("root").alias("next"))
            joined = roots.join(onward, "root", "left")
            roots = pin(joined.select("node", F.coalesce("next", "root").alias("root")))
        step += 1
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
