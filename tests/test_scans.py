from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.functions.scans import over_rows, positions, previous, running
from barline.operators.joins import nearest_ts


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for s in ("a", "b"):
        t = datetime(2024, 1, 1)
        for i in range(400):
            t += timedelta(hours=int(rng.integers(1, 40 if i % 50 == 0 else 4)))
            v = None if rng.random() < 0.2 else float(rng.integers(-5, 6))
            data.append((s, t, v))
    df = spark.createDataFrame(data, "series string, ts timestamp_ntz, v double").repartition(7)
    return df, pd.DataFrame(data, columns=["series", "ts", "v"])


@pytest.mark.parametrize("chunk_hours", [5, 100_000, None])
def test_running_matches_pandas(rows, chunk_hours):
    df, pdf = rows
    got = running(df, ["series"], ["ts"], sums={"s": F.coalesce("v", F.lit(0.0))}, lasts={"last": F.col("v")},
                  nexts={"next": F.col("v")}, chunk_hours=chunk_hours).toPandas().sort_values(["series", "ts"])
    g = pdf.groupby("series")["v"]
    assert np.allclose(got["s"].values, pdf["v"].fillna(0).groupby(pdf["series"]).cumsum().values)
    assert np.allclose(got["last"].values, g.ffill().values, equal_nan=True)
    assert np.allclose(got["next"].values, g.bfill().values, equal_nan=True)


@pytest.mark.parametrize("chunk_hours", [7, 100_000])
def test_positions_and_previous(rows, chunk_hours):
    df, pdf = rows
    got = previous(positions(df, ["series"], ["ts"], name="pos", chunk_hours=chunk_hours), ["series"], ["ts"],
                   {"p": "v"}, chunk_hours).toPandas().sort_values(["series", "ts"])
    assert list(got["pos"]) == list(range(400)) * 2
    assert np.allclose(got["p"].values.astype(float), pdf.groupby("series")["v"].shift().values, equal_nan=True)


@pytest.mark.parametrize("block_rows,chunk_hours", [(1, 9), (33, 50), (5000, 100_000)])
def test_frames_reach_across_blocks(rows, block_rows, chunk_hours):
    df, pdf = rows
    got = over_rows(df, ["series"], ["ts"], lambda w: {
        "lead": F.lead("v", 3).over(w), "mean": F.avg("v").over(w.rowsBetween(-6, 0)),
        "n": F.count(F.lit(1)).over(w.rowsBetween(1, 3)),
    }, before=6, after=3, block_rows=block_rows, chunk_hours=chunk_hours).toPandas().sort_values(["series", "ts"])
    g = pdf.groupby("series")["v"]
    assert len(got) == 800
    assert np.allclose(got["lead"].astype(float), g.shift(-3), equal_nan=True)
    assert np.allclose(got["mean"].astype(float), g.rolling(7, min_periods=1).mean().values, equal_nan=True)
    assert list(got["n"]) == ([3] * 397 + [2, 1, 0]) * 2


@pytest.mark.parametrize("chunk_hours", [3, None])
def test_nearest_prefers_earlier_on_ties(spark, chunk_hours):
    at = lambda h, m=0: datetime(2024, 1, 1) + timedelta(hours=h, minutes=m)
    stored = spark.createDataFrame([("s", at(0)), ("s", at(2)), ("s", at(40)), ("s", at(40))],
                                   "series string, ts timestamp_ntz")
    wanted = spark.createDataFrame([("s", at(1)), ("s", at(1, 1)), ("s", at(21)), ("s", at(22)), ("s", at(99)),
                                    ("t", at(1))], "series string, ts timestamp_ntz")
    got = {(r.series, r.ts): r.nearest_ts for r in nearest_ts(wanted, stored, chunk_hours=chunk_hours).collect()}
    assert got == {("s", at(1)): at(0), ("s", at(1, 1)): at(2), ("s", at(21)): at(2), ("s", at(22)): at(40),
                   ("s", at(99)): at(40), ("t", at(1)): None}
