"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each tree splits a node at about the median of its vectors along a random
direction; vectors near the cut go to both sides. Vectors that share a leaf are
compared exactly. Equal vectors are compared once. Trees grow in rounds: nodes
that are still too large get a subtree fitted on a bounded sample of their
vectors, and the vectors move down it.

Pairs never leave the task that finds them. Each vector knows all its leaves, so
a pair is counted in the first leaf that both are in; a task gives one count per
vector, and edges that chain what is linked within the leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.components import components, roots
from barline.llm.store import staged

COSINE = 0.93
TREES = 8
#: Vectors up to which a node is a leaf.
LEAF = 600
#: Share of a node's vectors, on each side of the cut, that go to both children.
SPILL = 0.05
#: Vectors on which the subtree of one node is fitted, about; and its depth at most.
SAMPLE, DEPTH = 4_000, 8
#: Projections (of deviation 1) this close to a cut go to both sides in any case.
NEAR = 0.01
#: A node that its subtree leaves larger than this share of itself is a leaf, whatever its size.
STUCK = 0.9
#: Vectors of a leaf compared in one task with as many others.
BLOCK = 4_096
SEED = 20_240_607


@lru_cache(maxsize=8_192)
def _direction(dim: int, tree: int, label: int, node: int, depth: int) -> np.ndarray:
    return np.random.default_rng([SEED, tree, label & 0xFFFFFFFFFFFF, node & 0xFFFFFFFFFFFF, depth]).standard_normal(dim)


def _unit(raw: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cut(p: np.ndarray) -> tuple[float, float] | None:
    """Lower and upper cut of projections: at the median, or as near to it as a
    place is that not too many vectors surround. A crowd of vectors that are all but
    alike goes to one side, whole. None if there is no such place."""
    for middle in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8):
        low, at, high = np.quantile(p, (middle - SPILL, middle, middle + SPILL))
        low, high = min(low, at - NEAR), max(high, at + NEAR)
        left, right = np.mean(p <= high), np.mean(p >= low)
        if left + right - 1 <= 6 * SPILL and max(left, right) <= STUCK:
            return float(low), float(high)
    return None


def _fit(x: np.ndarray, depth: int, tree: int, label: int, node: int) -> list[tuple[int, float, float]]:
    """(place in the subtree, lower and upper cut) of every inner node, the root at 1."""
    cuts, open_ = [], [(1, x)]
    while open_:
        place, part = open_.pop()
        if place >= 1 << depth or len(part) < 8:
            continue
        p = part @ _direction(x.shape[1], tree, label, node, place)
        found = _cut(p)
        if found:
            low, high = found
            cuts.append((place, low, high))
            open_ += [(2 * place, part[p <= high]), (2 * place + 1, part[p >= low])]
    return cuts


def _descend(x: np.ndarray, cuts: dict[int, tuple[float, float]], tree: int, label: int, node: int) -> list[tuple[int, np.ndarray]]:
    """Leaves of the subtree with the positions of their vectors."""
    out, open_ = [], [(1, np.arange(len(x)))]
    while open_:
        place, rows = open_.pop()
        if place not in cuts:
            if len(rows):
                out.append((place, rows))
            continue
        low, high = cuts[place]
        p = x[rows] @ _direction(x.shape[1], tree, label, node, place)
        open_ += [(2 * place, rows[p <= high]), (2 * place + 1, rows[p >= low])]
    return out


def _child(node: int, place: int) -> int:
    """A node's number below ``node``; a hash, as paths have no bounded length."""
    h = (node * 0x9E3779B97F4A7C15 + place * 0xBF58476D1CE4E5B9 + 1) & 0xFFFFFFFFFFFFFFFF
    h = ((h ^ (h >> 29)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (h ^ (h >> 32)) & 0x7FFFFFFFFFFFFFFF


def leaves(points: DataFrame, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``id`` and ``leaf`` (a number of label, tree and node), once for each leaf
    that a vector is in. A node is split until it has at most ``leaf`` vectors,
    or until a subtree of its own leaves a node that is hardly smaller: its
    vectors are then all but alike. Each node stops for itself."""
    kind = points.schema["vector"].dataType.simpleString()
    schema = f"id long, label long, vector {kind}, tree int, node long, was long"
    at = points.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))).withColumns(
        {"node": F.lit(1).cast("long"), "was": F.lit(None).cast("long")}).select("id", "label", "vector", "tree", "node", "was")
    finished = []
    while True:
        sizes = at.groupBy("label", "tree", "node").agg(F.count("*").alias("n"), F.max("was").alias("_was"))
        large = staged(sizes.where((F.col("n") > leaf) & (F.col("_was").isNull() | (F.col("n") <= STUCK * F.col("_was")))).drop("_was"), "large")
        named = F.xxhash64("label", "tree", "node").alias("leaf")
        if large.isEmpty():
            finished.append(at.select("id", named))
            break
        finished.append(at.join(large, ["label", "tree", "node"], "left_anti").select("id", named))
        rate = F.greatest(F.lit(1), F.floor(F.col("n") / SAMPLE))
        moving = at.join(large, ["label", "tree", "node"])
        sample = moving.where(F.pmod(F.xxhash64("id", "tree", "node"), rate) == 0)

        def fit(key, g: pd.DataFrame) -> pd.DataFrame:
            label, tree, node = (int(k) for k in key)
            depth = max(1, min(DEPTH, int(np.ceil(np.log2(g["n"].iat[0] / leaf) / (1 - np.log2(1 + 2 * SPILL))))))
            cuts = _fit(_unit(g["vector"]), depth, tree, label, node)
            return pd.DataFrame({"label": [label], "tree": [tree], "node": [node], "place": [[c[0] for c in cuts]],
                                 "low": [[c[1] for c in cuts]], "high": [[c[2] for c in cuts]]})

        fitted = staged(sample.groupBy("label", "tree", "node").applyInPandas(
            fit, "label long, tree int, node long, place array<long>, low array<double>, high array<double>"), "subtrees")

        def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                taken, nodes = [], []
                for (label, tree, node), own in rows.groupby(["label", "tree", "node"], sort=False).indices.items():
                    g = rows.iloc[own[:1]]
                    cuts = {int(p): (a, b) for p, a, b in zip(g["place"].iat[0], g["low"].iat[0], g["high"].iat[0])}
                    for place, part in _descend(_unit(rows["vector"].iloc[own]), cuts, int(tree), int(label), int(node)):
                        taken.append(own[part])
                        nodes.append(np.full(len(part), _child(int(node), place)))
                if taken:
                    out = rows[["id", "label", "vector", "tree", "n"]].iloc[np.concatenate(taken)]
                    yield out.rename(columns={"n": "was"}).assign(node=np.concatenate(nodes))

        # in order, so that a batch has few nodes and their directions are made once
        ready = moving.drop("was").join(fitted, ["label", "tree", "node"]).sortWithinPartitions("label", "tree", "node")
        at = staged(ready.mapInPandas(move, schema), "nodes")
    out = finished[0]
    for more in finished[1:]:
        out = out.union(more)
    return out


def compare_leaf(x: np.ndarray, copies: np.ndarray, seen: list, leaf: int, side: np.ndarray | None, least: float,
                 block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Per row of unit vectors ``x`` how many others (with their copies) it links
    with, counting a pair only where ``leaf`` is the least number in the lists
    ``seen`` of both; and the smallest row that links reach. With ``side`` only pairs of different sides are looked at."""
    # which earlier leaves each row is in, a bit each; a leaf of one row alone tells nothing
    owner = np.repeat(np.arange(len(x)), [len(s) for s in seen])
    names, which, times = np.unique(np.concatenate(seen), return_inverse=True, return_counts=True)
    useful = (names < leaf) & (times > 1)
    place = np.where(useful, np.cumsum(useful) - 1, -1)[which]
    bits = np.zeros((len(x), max(1, -(-int(useful.sum()) // 64))), np.uint64)
    some = place >= 0
    np.bitwise_or.at(bits, (owner[some], place[some] // 64), np.uint64(1) << (place[some] % 64).astype(np.uint64))
    counts, root = np.zeros(len(x), np.int64), np.arange(len(x))
    for i in range(0, len(x), block):
        for j in range(i, len(x), block):
            p, q = np.nonzero(x[i:i + block] @ x[j:j + block].T >= least)
            p, q = p + i, q + j
            pair = p < q if side is None else (p < q) & (side[p] != side[q])
            p, q = p[pair], q[pair]
            if not len(p):
                continue
            first = np.ones(len(p), bool)
            for w in range(bits.shape[1]):
                first &= (bits[p, w] & bits[q, w]) == 0
            counts += np.bincount(p[first], copies[q[first]], len(x)).astype(np.int64) + np.bincount(q[first], copies[p[first]], len(x)).astype(np.int64)
            root = roots(len(x), np.concatenate((np.arange(len(x)), p)), np.concatenate((root, q)))
    return counts, root


def links(points: DataFrame, at: DataFrame, least: float = COSINE) -> DataFrame:
    """Per leaf and vector ``id``: ``others``, the linked vectors counted in this
    leaf, and ``to``, the smallest vector that links reach within it. Verified in
    double precision. A leaf of more than BLOCK vectors is compared block by block in tasks of their own."""
    at = staged(at.distinct(), "leaves")
    sizes = at.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
    of_vector = at.groupBy("id").agg(F.sort_array(F.collect_list("leaf")).alias("seen"))  # as many as trees and spills
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = at.join(sizes, "leaf").withColumn("k", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    placed = placed.withColumn("o", other).select("id", "leaf", "k", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"))
    full = placed.join(of_vector, "id").join(points.select("id", "vector", "copies"), "id")
    groups = ["leaf", "i", "j"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None

        def found(g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values("id")
            ids, split = g["id"].to_numpy(), g["i"].iat[0] != g["j"].iat[0]
            n, root = compare_leaf(_unit(g["vector"]), g["copies"].to_numpy(), list(g["seen"]), int(g["leaf"].iat[0]),
                                   g["k"].to_numpy() if split else None, least)
            some = np.flatnonzero((n > 0) | (root != np.arange(len(g))))
            return pd.DataFrame({"id": ids[some], "others": n[some], "to": ids[root[some]]})

        for rows in batches:
            rows = rows if held is None else pd.concat((held, rows), ignore_index=True)
            key = rows[groups].to_numpy()
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
            for s, e in zip(edges, edges[1:]):
                if e - s > 1:
                    yield found(rows.iloc[s:e])
            held = rows.iloc[edges[-1]:]
        if held is not None and len(held) > 1:
            yield found(held)

    spread = full.repartition(*groups).sortWithinPartitions(*groups)
    return spread.mapInPandas(compare, "id long, others long, to long")


def near_vectors(rows: DataFrame, least: float = COSINE, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``rows`` (``vec_id`` long, ``embedding``, ``label``;
    other columns are ignored): ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their labels are equal and not NULL and their cosine is
    ``least`` or more. NULL vectors, empty or zero ones, those with NULL or
    non-finite components and rows without a vec_id link with nothing; vectors
    of different lengths don't link. Equal vectors of a label, repeated rows among them, are one point
    of the index and link with each other. ``component_id`` is the smallest
    vec_id that links reach.
    """
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = (F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", finite) & F.exists("embedding", lambda v: v != 0))
    # labels of any type, and lengths, as one number
    label = F.xxhash64("label", F.size("embedding"))
    kind = "float" if rows.schema["embedding"].dataType.elementType.simpleString() == "float" else "double"
    vector = F.transform("embedding", lambda v: (v + F.lit(0.0)).cast(kind))  # no negative zeros
    whole = rows.select("vec_id", F.when(F.coalesce(usable, F.lit(False)), vector).alias("vector"), label.alias("label"))
    points = staged(whole.where("vector is not null").groupBy("label", "vector").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("copies")), "points")
    linked = staged(links(points, leaves(points, trees, leaf), least), "links")
    totals = linked.groupBy("id").agg(F.sum("others").alias("others"))
    joined = components(linked.where("id <> to").select(F.col("to").alias("a"), F.col("id").alias("b")))
    known = (points.join(totals, "id", "left").join(joined.withColumnRenamed("node", "id"), "id", "left")
             .where("copies > 1 or others is not null"))
    out = whole.join(known, ["label", "vector"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).otherwise(F.col("vec_id"))
    n = F.when(F.col("id").isNotNull(), F.col("copies") - 1 + F.coalesce("others", F.lit(0))).otherwise(F.lit(0))
    return out.select("vec_id", n.cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
