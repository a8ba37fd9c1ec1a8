"""Connected components of an edge table, by alternating large-star and small-star steps. Before each of these every
task replaces its own edges by stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.sources.scratch import materialize

#: Edges that a task looks at together, and those for which a round takes one more task.
TOGETHER, IN_TASK = 200_000, 50_000


def local_stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) of the nodes of some edges, but for the least ones themselves."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((above := root[root]) != root).any():
            root = above
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy() for c in (0, 1)]))
        size += len(batch)
        if size >= TOGETHER:
            yield _batch(held)
            held, size = [], 0
    if size:
        yield _batch(held)


def _batch(held: list[np.ndarray]) -> pa.RecordBatch:
    u, v = local_stars(*np.concatenate(held, axis=1))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """(u, v) pairs with m, the least of u and all its neighbours. The minimum is taken
    map-side first, so a node with very many neighbours costs one row per task."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least_neighbour(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    star = _least_neighbour(down)
    return (
        star.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionAll(star.select("u", F.col("m").alias("v")))
        .where("u <> v")
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down, or edges from above only."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    found = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return found.where("down > 1 or (down = 1 and up = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the long pairs (u, v); component is its least node.

    Only nodes with an edge to another node come out. Rows stay linear in the edges, each
    round is written to the scratch folder, and rounds grow with the logarithm of the longest path at most.
    """
    # Not contracted where they are made: a task that makes them in Python would need a second worker.
    current = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    while True:
        # Edges that fit a task need no round; more of them are spread over more tasks.
        rows = current.count()
        tasks = rows // IN_TASK + 1
        current = materialize(current.coalesce(tasks).mapInArrow(_contract, "u long, v long"), "edges")
        if tasks == 1 or _are_stars(current):
            break
        current = materialize(_small_star(_large_star(current).distinct()).distinct(), "edges")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
