from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from barline.llm import rp_forest
from barline.llm.rp_forest import compare_leaf, leaves, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def brute(rows):
    def unit(v):
        x = np.asarray([np.nan if c is None else c for c in v or []], np.float64)
        n = np.sqrt((x * x).sum())
        return x / n if len(x) and np.isfinite(x).all() and n > 0 else None

    units = [None if r[2] is None or r[0] is None else unit(r[1]) for r in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), c, rows[i][0] is not None and rows[i][0] == c))
    return out


def key(r):
    return tuple((x is None, x or 0) for x in r)


def test_small_table_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(12):
        base = rng.standard_normal(16)
        for _ in range(6):
            rows.append((len(rows), (base + rng.standard_normal(16) * 0.15).astype(np.float32).tolist(), c % 3))
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(5)]
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1e30] * 16, [1e-30] * 16, [1.0] * 8]
    rows += [(200 + i, v, 0) for i, v in enumerate(bad)] + [(300, rows[0][1], None), (None, rows[0][1], 0), (0, rows[0][1], rows[0][2])]
    got = [tuple(r) for r in near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("copies", [0, 500])
def test_recall_through_several_rounds(spark, copies):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((500, 32))
    made = np.repeat(base, 6, axis=0) + rng.standard_normal((3000, 32)) * 0.2
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(made)]
    rows += [(10_000 + i, rows[0][1], 1) for i in range(copies)]
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), leaf=40).collect()}
    x = np.array([r[1] for r in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    found = np.array([got[r[0]] for r in rows])
    assert (found <= want).all()
    assert found[:3000].sum() >= 0.97 * want[:3000].sum() > 0
    if copies:
        assert found[0] >= copies and found[-1] >= copies


def crowd(n, dim, seed, copies=3, spread=0.2):
    """Random directions, some with near copies."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    near = np.repeat(base[: n // 10], copies, axis=0)
    return np.vstack((base, near + rng.standard_normal(near.shape) * spread))


def test_recall_of_full_trees_in_one_label(spark):
    """12,000 vectors of one label and leaves of 100: trees of about eight levels, in several rounds."""
    made = crowd(9_230, 32, 7).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(made)], SCHEMA)
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(df, leaf=100).collect()}
    x = made.astype(np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = np.concatenate([(x[i:i + 2000] @ x.T >= 0.93).sum(axis=1) - 1 for i in range(0, len(x), 2000)])
    found = np.array([got[i] for i in range(len(x))])
    assert len(x) > 11_900 and (found <= want).all()
    assert want.sum() > 8_000 and found.sum() >= 0.95 * want.sum(), (found.sum(), want.sum())


def sizes_of_leaves(spark, made, leaf):
    points = spark.createDataFrame([(i, 5, v.tolist(), 1) for i, v in enumerate(made)], "id long, label long, vector array<float>, copies long")
    at = leaves(points, 3, leaf)
    sizes = at.groupBy("leaf").count().collect()
    return max(r["count"] for r in sizes), at.select("id").distinct().count(), at.count()


def test_no_leaf_is_larger_than_asked(spark):
    most, ids, rows = sizes_of_leaves(spark, crowd(8_000, 16, 3).astype(np.float32), 60)
    assert most <= 60 and ids == 10_400 and rows < 3 * 10_400 * 3


def test_vectors_alike_stay_together_and_others_are_split(spark, monkeypatch):
    """A third of one label is all but the same vector, too much for one task."""
    monkeypatch.setattr(rp_forest, "BLOCK", 64)
    rng = np.random.default_rng(4)
    alike = np.tile(rng.standard_normal(16), (400, 1)) * (1 + np.arange(400)[:, None])  # one direction
    others = rng.standard_normal((800, 16))
    made = np.vstack((alike, others))
    df = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(made)], SCHEMA.replace("float", "double"))
    got = {r["vec_id"]: r for r in near_vectors(df, leaf=50).collect()}
    assert all(got[i]["n_links"] >= 399 and got[i]["component_id"] == 0 for i in range(400))
    x = made / np.sqrt((made * made).sum(axis=1, keepdims=True))
    want = (x @ x.T >= 0.93).sum(axis=1) - 1
    assert sum(got[i]["n_links"] for i in range(1200)) == want.sum()


@pytest.mark.parametrize("sides", [False, True])
def test_pairs_count_in_their_first_common_leaf(sides):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((60, 3))
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    copies = rng.integers(1, 4, 60)
    seen = [np.unique(rng.integers(0, 400, rng.integers(1, 120)).tolist() + [200]) for _ in range(60)]
    side = rng.integers(0, 2, 60) if sides else None
    n, root = compare_leaf(x, copies, seen, 200, side, 0.8, block=16)
    want = np.zeros(60, int)
    for i in range(60):
        for j in range(60):
            if i != j and x[i] @ x[j] >= 0.8 and (side is None or side[i] != side[j]) and min(set(seen[i]) & set(seen[j])) == 200:
                want[i] += copies[j]
    assert n.tolist() == want.tolist()
    assert (root <= np.arange(60)).all()


def test_double_vectors_are_compared_in_double_precision(spark):
    """Two vectors whose cosine is below the bound by less than a float tells."""
    angle = np.arccos(0.93) + 1e-9
    rows = [(1, [1.0, 0.0], 1, "x"), (2, [float(np.cos(angle)), float(np.sin(angle))], 1, "x"), (3, [float(np.cos(angle - 2e-9)), float(np.sin(angle - 2e-9))], 1, "x")]
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double"))).collect()}
    assert got == {1: 1, 2: 1, 3: 2}
    assert near_vectors(spark.createDataFrame(rows, SCHEMA.replace("float", "double")).where(F.lit(False))).count() == 0
