"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.store import staged


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position linked with each position."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours under its smallest one."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours under the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node
    of ``edges`` (``a``, ``b``); nodes without an edge to another are left out.

    Each round is written to the shared folder; only a count and a checksum come
    to the driver. Rounds grow with the logarithm of the longest chain.
    """
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), "edges")
    seen = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "edges")
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen:
            break
        seen = mark
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b").distinct())
