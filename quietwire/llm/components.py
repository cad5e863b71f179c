"""Connected components of a graph given as pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quietwire.llm.common import in_batches
from quietwire.session import stage

# Pairs that a task works on at a time: two numbers each, so some tens of MB.
TASK_PAIRS = 1_000_000


def labels(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) within these pairs, for nodes that are not the least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        # Hang the roots of both ends under the lesser one, then shorten all paths.
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            short = root[root]
            if np.array_equal(short, root):
                break
            root = short
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _contracted(pairs: DataFrame) -> DataFrame:
    """Every task replaces its pairs by stars around the least node of each of their components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.zeros(0, np.int64)
        held = [(empty, empty)]
        rows = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            rows += batch.num_rows
            if rows > 4 * TASK_PAIRS:
                held = [labels(*(np.concatenate(c) for c in zip(*held)))]
                rows = len(held[0][0])
        node, least = labels(*(np.concatenate(c) for c in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(least)], ["a", "b"])

    return in_batches(pairs.select("a", "b"), work, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it is connected to.

    Tasks of a fixed number of pairs contract what they hold. What fits one task is done with that.
    More pairs are dealt by either end, again and again: each round brings a node's neighbours
    together, joins their stars, and ends when no pair changes. Rounds grow with the logarithm of
    the longest path, less what the tasks contract by themselves.
    """
    edges, step = stage(links.select("a", "b").where("a <> b").distinct(), "edges-0"), 0
    state = None
    while True:
        step += 1
        tasks = -(-edges.count() // TASK_PAIRS)
        if tasks <= 1:
            edges = stage(_contracted(edges.coalesce(1)), f"edges-{step}")
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = stage(_contracted(both.repartition(2 * tasks, "a")).distinct(), f"edges-{step}")
        before, state = state, edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return stage(edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots), "roots")
