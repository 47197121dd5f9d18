"""Connected components of a graph of links, without collecting it anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, tidied


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (u > v)."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


#: Edges that are contracted at once; it bounds what a task holds.
CHUNK = 500_000


def _forest(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """Edges from each node to the least node that these edges connect it with."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    u, v, root = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        if np.array_equal(low, high):
            break
        np.minimum.at(root, high, low)
        while not np.array_equal(up := root[root], root):
            root = up
    below = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[below]), pa.array(nodes[root[below]])], names=["u", "v"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0
    for batch in batches:
        waiting.append([batch.column(i).to_numpy() for i in (0, 1)])
        size += batch.num_rows
        if size >= CHUNK:
            yield _forest(*(np.concatenate(x) for x in zip(*waiting)))
            waiting, size = [], 0
    if size:
        yield _forest(*(np.concatenate(x) for x in zip(*waiting)))


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges (u > v) that connect the same nodes: each task has each of its nodes point to the least one it knows of."""
    return edges.mapInArrow(tidied(_contract), "u long, v long")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is the least node reachable.

    ``edges`` has two columns of integers in either order; nulls, loops and repeated edges do no harm. Tasks contract their
    own edges without a shuffle, then large-star and small-star steps connect those of different tasks, until every node
    points to one node that points nowhere; each round is written to the shared folder.
    """
    a, b = (F.col(c).cast("long") for c in edges.columns[:2])
    edges = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialise(contracted(edges).distinct(), "edges")
    for _ in range(most):
        old, edges = edges, materialise(contracted(edges), "edges")
        discard(old)
        ends = edges.select(F.col("u").alias("node"), "v").union(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v")))
        nodes = ends.groupBy("node").agg(F.min("v").alias("least"), F.max("v").alias("last"), F.bool_or(F.col("v").isNull()).alias("top"))
        nodes = materialise(nodes, "nodes")
        if nodes.where("least < last or (least is not null and top)").isEmpty():
            discard(edges)
            return nodes.select("node", F.coalesce("least", "node").alias("component"))
        old, edges = edges, materialise(_stars(_stars(edges, True), False), "edges")
        discard(old, nodes)
    raise RuntimeError(f"components did not settle in {most} rounds")
