"""Connected components: chunks of edges are solved in their tasks, then joined
by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ints

MOST_ROUNDS = 60
TASK_EDGES = 1_000_000  # edges that a task solves at a time


def _to_smallest(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links each node's neighbours (large star: the larger ones; small star:
    the smaller ones and itself) to the smallest node next to it.

    The smallest is an aggregate with partial sums in each task, then joined
    back, so a node with very many neighbours is never gathered in one place.
    """
    if larger_only:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if larger_only:
        out = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def _forest(edges: DataFrame, tasks: int, task_edges: int) -> DataFrame:
    """Each chunk's edges as (a, b): a node and the smallest it reaches there."""
    return edges.coalesce(tasks).mapInArrow(lambda batches: _solved(batches, task_edges), "a long, b long")


def _solved(batches, task_edges: int):
    held, size = [], 0

    def out():
        edges = np.concatenate(held)
        nodes, at = np.unique(edges, return_inverse=True)
        a, b = at.reshape(edges.shape).T
        root = np.arange(len(nodes))
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (root[root] != root).any():
                root = root[root]
        linked = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[linked]), pa.array(nodes[root[linked]])], ["a", "b"])

    for batch in batches:
        for lo in range(0, batch.num_rows, task_edges):
            part = batch.slice(lo, task_edges)
            if held and size + part.num_rows > task_edges:
                yield out()
                held, size = [], 0
            held.append(np.stack([ints(part.column(0)), ints(part.column(1))], 1))
            size += part.num_rows
    if size:
        yield out()


def _settled(edges: DataFrame) -> bool:
    """Whether each node hangs on one other, which hangs on none."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))).alias("x")).select("x.*")
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return ends.filter(F.col("below") + F.col("above") > 1).isEmpty()


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component): each linked node and the smallest node it reaches.

    ``edges`` has columns a and b, both long.  Tasks first solve chunks of at
    most ``task_edges`` edges by themselves; if there is more than one chunk,
    star steps join what they found.  Each round is written to the shared
    checkpoint folder; only counts come to the driver.
    """
    now = cut(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    for _ in range(MOST_ROUNDS):
        chunks = -(-now.count() // task_edges)
        if chunks:
            now = cut(_forest(now, chunks, task_edges), "edges")
        if chunks < 2 or _settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        now = cut(_to_smallest(_to_smallest(now, True), False), "edges")
    raise RuntimeError("components did not settle")
