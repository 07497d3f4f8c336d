from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import binning as b

INF = float("inf")


def frame(spark, values, **more):
    cols = {"id": list(range(len(values))), "v": values, **more}
    rows = list(zip(*cols.values()))
    kinds = ["id long", *[f"{c} double" for c in cols if c != "id"]]
    return spark.createDataFrame(rows, ", ".join(kinds)) if rows else spark.createDataFrame([], ", ".join(kinds))


def spec_of(spark, values, n, **kw):
    return b.equal_count_bins(frame(spark, values), "v", "id", n, **kw).orderBy("bin").toPandas()


@pytest.mark.parametrize("n,bins", [(97, 10), (1000, 7), (10, 10)])
def test_counts_differ_by_at_most_one(spark, n, bins):
    rng = np.random.default_rng(1)
    values = [float(x) for x in rng.integers(0, 5, n)]
    spec = spec_of(spark, values, bins, n_cells=6)
    assert spec["n"].sum() == n and spec["n"].max() - spec["n"].min() <= 1
    order = pd.Series(values).rank(method="first").astype(int) - 1
    want = (order * bins // n).groupby(order * bins // n).size()
    assert list(spec["n"]) == list(want)


def test_fewer_values_than_bins(spark):
    spec = spec_of(spark, [3.0, 1.0], 5)
    assert list(spec["n"]) == [1, 0, 1, 0, 0]
    assert list(spec["p_low"]) == [1.0, 1.0, 3.0, 1.0, 1.0]
    assert list(spec["p_high"]) == [1.0, 1.0, 3.0, 3.0, 3.0]
    assert list(spec["p_center"]) == [1.0, 1.0, 3.0, 3.0, 3.0]
    assert list(spec["edge_lo"]) == [-INF, 1.0, 1.0, 3.0, 3.0]


def test_missing_values_are_left_out(spark):
    spec = spec_of(spark, [None, 2.0, float("nan"), 1.0], 2)
    assert list(spec["n"]) == [1, 1] and list(spec["p_high"]) == [1.0, 2.0]


def test_no_bins_is_an_error(spark):
    with pytest.raises(ValueError):
        b.equal_count_bins(frame(spark, [1.0]), "v", "id", 0)
    with pytest.raises(ValueError):
        b.equal_count_bins(frame(spark, [None, float("nan")]), "v", "id", 3)


def test_assign_edges_and_policies(spark):
    spec = b.equal_count_bins(frame(spark, [1.0, 1.0, 1.0, 2.0, 3.0, 4.0]), "v", "id", 3)
    # Upper edges 1, 2, 4; intervals are closed on the right.
    x = frame(spark, [0.0, 1.0, 1.5, 2.0, 4.0, 4.1, None, -INF, INF, float("nan")])
    for policy, want in {
        "clip": [0, 0, 1, 1, 2, 2, -1, 0, 2, -1],
        "ignore": [0, 0, 1, 1, 2, -1, -1, -1, -1, -1],
    }.items():
        got = [r.bin for r in b.assign_bins(x, "v", spec, policy).orderBy("id").collect()]
        assert got == want, policy
    with pytest.raises(Exception, match="out-of-range"):
        b.assign_bins(x, "v", spec, "error").collect()
    with pytest.raises(ValueError):
        b.assign_bins(x, "v", spec, "other")


def test_tied_edges_go_to_the_lowest_bin(spark):
    spec = b.equal_count_bins(frame(spark, [5.0] * 6), "v", "id", 3)
    got = [r.bin for r in b.assign_bins(frame(spark, [4.0, 5.0]), "v", spec).orderBy("id").collect()]
    assert got == [0, 0]


def test_summary_weights(spark):
    spec = b.equal_count_bins(frame(spark, [1.0, 2.0, 3.0, 4.0]), "v", "id", 2)
    rows = frame(spark, [1.0, 2.0, 3.0, 9.0, 4.0], y=[1.0, 0.0, 1.0, 1.0, None], w=[1.0, 3.0, 0.0, 1.0, None])
    plain = b.summarize_bins(rows, "v", "y", spec).orderBy("bin").collect()
    assert [(r.n, r.mean_y) for r in plain] == [(2, 0.5), (2, 1.0)]
    weighted = b.summarize_bins(rows, "v", "y", spec, weight="w").orderBy("bin").collect()
    assert [(r.n, r.mean_y, r.w_sum) for r in weighted] == [(2, 0.25, 4.0), (1, None, 0.0)]


def test_empty_bins_are_listed(spark):
    spec = b.equal_count_bins(frame(spark, [1.0, 2.0, 3.0]), "v", "id", 3)
    out = b.summarize_bins(frame(spark, [2.5], y=[1.0]), "v", "y", spec).orderBy("bin").collect()
    assert [(r.bin, r.n, r.mean_y) for r in out] == [(0, 0, None), (1, 0, None), (2, 1, 1.0)]


@pytest.mark.parametrize("method", ["first", "average", "min", "max", "dense"])
def test_rank_bins(spark, method):
    rng = np.random.default_rng(2)
    values = [None if rng.random() < 0.1 else float(x) for x in rng.integers(0, 20, 500)]
    got = b.rank_bins(frame(spark, values), "v", "id", 6, method, n_cells=5).orderBy("id").toPandas()["bin"]
    ranks = pd.Series(values, dtype=float).rank(method=method)
    want = np.floor((ranks - 1) * 6 / len(values)).clip(0, 5).fillna(-1).astype(int)
    assert list(got) == list(want)


def test_calibration_drops_incomplete_rows(spark):
    rows = frame(spark, [0.1, 0.2, 0.3, 0.4, None], y=[0.0, 1.0, None, 1.0, 1.0])
    got = b.calibration(rows, "v", "y", "id", 3).orderBy("mean_p").collect()
    assert [(r.bin, r.n, r.mean_p, r.mean_y) for r in got] == [(0, 1, 0.1, 0.0), (1, 1, 0.2, 1.0), (2, 1, 0.4, 1.0)]


def test_bins_per_series(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=900)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else "cold", float(x)) for i, x in enumerate(v)],
                                 "id long, s string, v double")
    spec = b.equal_count_bins(rows, "v", "id", 4, ["s"], n_cells=8).groupBy("s").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.sum("n").alias("n")).orderBy("s").collect()
    assert [(r.s, r.lo, r.hi, r.n) for r in spec] == [("cold", 75, 75, 300), ("hot", 150, 150, 600)]
