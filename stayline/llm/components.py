"""Connected components by alternating stars, with lineage cut in the shared folder."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.sources.shared import ensure_checkpoints


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of every node move to its smallest neighbour."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a long, b long)``.

    The component is its smallest node.  Rounds grow with the logarithm of the longest
    path; a node with very many neighbours only meets reduced rows, and joins on it are
    split by adaptive execution.  Edges from a node to itself only add the node.
    """
    ensure_checkpoints(edges.sparkSession)
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.col("a").cast("long"), F.col("b").cast("long")).distinct().checkpoint()
    nodes = _both_ways(edges).select(F.col("a").alias("node")).distinct()
    state, seen = edges.where("a != b"), None
    while True:
        state = _small_star(_large_star(state)).checkpoint()
        mark = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def reached(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each row and column of a link matrix reaches through it."""
    low, high = left.copy(), right.copy()
    rows, columns = mask.any(axis=1), mask.any(axis=0)
    todo = rows.copy()
    while todo.any():
        reach, across = np.zeros(len(left), bool), np.zeros(len(right), bool)
        front = np.zeros(len(left), bool)
        front[np.argmax(todo)] = True
        while front.any():
            reach |= front
            new = mask[front].any(axis=0) & ~across
            across |= new
            front = mask[:, new].any(axis=1) & ~reach if new.any() else np.zeros(len(left), bool)
        least = min(left[reach].min(), right[across].min())
        low[reach], high[across] = least, least
        todo &= ~reach
    return np.where(rows, low, left), np.where(columns, high, right)
