from __future__ import annotations

from datetime import datetime, timedelta

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import indicators as ind
from barline.operators import series as w

FRAMES = {"1H": "1h", "4H": "4h", "12H": "12h", "1D": "1D"}


def resample(pdf, rule):
    return pdf.set_index("ts").resample(rule).agg(
        {"open": "first", "high": "max", "low": "min", "close": "last", "volume": "sum"}).dropna(subset=["close"])


def test_lookback_sizes_and_labels(hourly, bars_of):
    pdf = hourly(800)
    bars = bars_of(pdf)
    last = bars.where(F.col("ts") == F.lit(str(pdf.ts.iloc[-1])).cast("timestamp_ntz"))
    store = w.lookback(bars, last, 720).toPandas()
    for tf, n in {"1H": 720, "4H": 180, "12H": 60, "1D": 30}.items():
        got = store[store.timeframe == tf].sort_values("bar_ts")
        want = resample(pdf, FRAMES[tf]).tail(n)
        assert len(got) == n
        assert got.bar_ts.iloc[-1] == pdf.ts.iloc[-1].floor(FRAMES[tf])
        assert list(got.bar_ts) == list(want.index)
        assert np.allclose(got[["open", "high", "low", "close", "volume"]].values, want.values)
    assert set(store.ts_key) == {pdf.ts.iloc[-1].strftime("%Y%m%d_%H%M%S")}


def test_lookback_of_many_targets_with_gaps(hourly, bars_of):
    pdf = hourly(120, drop=[7, 8, 9, 30, 31, 77])
    bars = bars_of(pdf)
    store = w.lookback(bars, bars, 16, ["1H", "4H"], chunk_hours=10).toPandas()
    for tf, n in {"1H": 16, "4H": 4}.items():
        for ts in pdf.ts:
            want = resample(pdf[pdf.ts <= ts], FRAMES[tf]).tail(n)
            got = store[(store.timeframe == tf) & (store.ts == ts)].sort_values("bar_ts")
            assert list(got.bar_ts) == list(want.index)
            assert np.allclose(got[["open", "high", "low", "close", "volume"]].values, want.values)


def test_trim_and_exactness(hourly, bars_of):
    bars = bars_of(hourly(100))
    end = bars.where(F.col("ts") == F.lit("2024-01-05 02:00:00").cast("timestamp_ntz"))
    wide = w.lookback(bars, end, 54, ["1H", "4H"])
    assert wide.count() == 54 + 13
    checked = {r.timeframe: (r.n, r.expected, r.exact) for r in w.validate_exact(w.trim_lookback(wide, 48), 48).collect()}
    assert checked == {"1H": (48, 48, True), "4H": (12, 12, True)}
    assert not any(r.exact for r in w.validate_exact(wide, 48).collect())


def test_forward_return_goes_by_row(hourly, bars_of):
    pdf = hourly(60, drop=[10, 11, 40])
    pdf.loc[5, "close"] = np.nan
    got = w.forward_return(bars_of(pdf), 6, chunk_hours=7, block_rows=9).toPandas().set_index("ts")["y_true"]
    want = np.log(pdf.close.shift(-6) / pdf.close)
    want.index = pdf.ts
    want = want.dropna()
    assert list(got.sort_index().index) == list(want.index) and np.allclose(got.sort_index(), want)


def test_short_windows_use_the_last_bar(hourly, bars_of):
    pdf = hourly(20)
    got = w.forward_return(bars_of(pdf), 6, log=False, min_forward=2).toPandas().sort_values("ts")
    assert len(got) == 18
    assert np.isclose(got.y_true.iloc[-1], pdf.close.iloc[-1] / pdf.close.iloc[17] - 1)
    with pytest.raises(ValueError):
        w.forward_return(bars_of(pdf), 0)


def test_target_rows(hourly, bars_of):
    pdf = hourly(60, drop=[20])
    rows = w.generate_targets(bars_of(pdf), start="2024-01-01 04:00", end="2024-01-01 18:00", horizon=5,
                              log=False, feature_key="k").orderBy("timestamp").collect()
    # The gap at hour 20 leaves entries from 15:00 on one bar short of 5 within 5 hours of the end.
    assert [r.timestamp.hour for r in rows] == list(range(4, 18))
    assert set((r.target_name, r.horizon_bars, r.target_label, r.feature_key) for r in rows) == {("y_ret_5h", 5, "5h", "k")}


@pytest.mark.parametrize("chunk_hours", [4, 100_000])
def test_obv(hourly, bars_of, chunk_hours):
    pdf = hourly(50)
    pdf.loc[[3, 17, 18], "close"] = np.nan
    pdf.loc[22, "volume"] = np.nan
    pdf.loc[30, "close"] = pdf.loc[29, "close"]
    want = [0.0]
    for i in range(1, 50):
        a, c, v = pdf.close[i - 1], pdf.close[i], pdf.volume.fillna(0)[i]
        want.append(want[-1] + (0 if np.isnan(a) or np.isnan(c) else float(np.sign(c - a)) * v))
    got = w.obv(bars_of(pdf), chunk_hours=chunk_hours).orderBy("ts").toPandas()
    assert np.allclose(got.obv, want)


@pytest.mark.parametrize("chunk_hours", [6, 100_000])
def test_continuity(spark, hourly, bars_of, chunk_hours):
    pdf = hourly(40, drop=[12])
    twice = pd.concat([pdf, pdf[pdf.ts == "2024-01-01 20:00"]])
    bars = bars_of(twice)
    got = {r.ts.hour + 24 * (r.ts.day - 1): r.continuous for r in w.continuity(bars, bars, 5).collect()}
    want = {h: not (h < 4 or 12 <= h <= 16 or 20 <= h <= 24) for h in range(40) if h != 12}
    assert got == want
    absent = spark.createDataFrame([("s", datetime(2024, 1, 1, 12))], "series string, ts timestamp_ntz")
    assert w.continuity(bars, absent, 3).first().continuous is False
    with pytest.raises(w.BrokenHistory):
        w.require_continuity(bars, absent, 3)
    assert [r.ts.hour for r in w.missing_hours(bars, chunk_hours=chunk_hours).collect()] == [12]


def test_partial_last_row_and_history(hourly, bars_of):
    pdf = hourly(50)
    half = pdf.tail(1).assign(ts=pdf.ts.iloc[-1] + timedelta(minutes=30))
    bars = bars_of(pd.concat([pdf, half]))
    assert w.trim_partial(bars).count() == 50
    assert w.require_history(bars, 48).count() == 50
    assert w.history(bars, 48).first().latest_ts == pdf.ts.iloc[-1].to_pydatetime()
    with pytest.raises(w.BrokenHistory):
        w.require_history(bars, 72)


def expected(pdf, tf, spec, n):
    """Textbook indicators of the newest bar of a window, with pandas."""
    lb = resample(pdf, FRAMES[tf]).tail(n)
    out = {}
    for k in spec.sma:
        out[f"close_sma_{k}_{tf}"] = lb.close.rolling(k).mean().iloc[-1]
    out[f"volume_ma_{spec.volume_ma}_{tf}"] = lb.volume.rolling(spec.volume_ma).mean().iloc[-1]
    step = lb.close.diff()
    gain = step.clip(lower=0).where(step.notna()).rolling(spec.rsi).mean().iloc[-1]
    loss = (-step).clip(lower=0).where(step.notna()).rolling(spec.rsi).mean().iloc[-1]
    out[f"close_rsi_{spec.rsi}_{tf}"] = 100 * gain / (gain + loss)
    fast, slow = (lb.close.ewm(span=s, adjust=False).mean().iloc[-1] for s in spec.macd)
    out[f"close_macd_{tf}"] = fast - slow
    return out


def test_recomputed_features(hourly, bars_of):
    pdf = hourly(300, drop=[100])
    spec = ind.IndicatorSpec(sma=(3, 20), rsi=6, macd=(12, 26), volume_ma=4)
    bars = bars_of(pdf)
    got = ind.recompute_features(bars, bars.where("hour(ts) in (2, 15, 23)"), 96, 6, ["1H", "4H", "1D"], spec,
                                 chunk_hours=48).toPandas().sort_values("ts")
    assert len(got) > 8
    gap = pd.Timestamp("2024-01-05 04:00")
    assert not ((got.ts >= gap) & (got.ts < gap + timedelta(hours=102))).any()
    for _, row in got.iterrows():
        seen = pdf[pdf.ts <= row.ts]
        for tf, n in {"1H": 96, "4H": 24, "1D": 4}.items():
            for name, value in expected(seen, tf, spec, n).items():
                assert np.isclose(row[name], value, atol=1e-9) or (pd.isna(row[name]) and np.isnan(value)), (row.ts, name)


def test_indicators_over_a_long_series(hourly, bars_of):
    """Long enough for several blocks of the exponential averages."""
    pdf = hourly(9000)
    got = ind.indicators(bars_of(pdf), "1H", chunk_hours=1000).toPandas().sort_values("ts")
    fast, slow = (pdf.close.ewm(span=s, adjust=False).mean() for s in (12, 26))
    assert np.allclose(got.close_macd_1H, fast - slow, atol=1e-9)
    assert np.allclose(got.close_sma_20_1H.astype(float), pdf.close.rolling(20).mean(), equal_nan=True)


def test_spans_too_different_for_one_block(hourly, bars_of):
    pdf = hourly(3000)
    got = ind.ema_columns(bars_of(pdf).select("series", "ts", "close"), "close", [2, 60], ["series"], ["ts"]).toPandas()
    got = got.sort_values("ts")
    for s in (2, 60):
        assert np.allclose(got[f"_ema_{s}"], pdf.close.ewm(span=s, adjust=False).mean(), atol=1e-9)


def test_lags(hourly, bars_of):
    pdf = hourly(40)
    got = ind.lag_features(bars_of(pdf), ["close"], 14, "4H").toPandas().sort_values("ts")
    assert np.allclose(got["close_lag_14_4H"].astype(float), pdf.close.shift(14), equal_nan=True)
    assert list(got.columns)[:3] == ["series", "ts", "close_4H"]


def far_apart(spark):
    """Two long series with a gap each, and three targets."""
    bars = spark.range(2 * 6000).where("id % 6000 not in (40, 3000)").select(
        F.concat(F.lit("s"), F.floor(F.col("id") / 6000).cast("string")).alias("series"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_interval(hours=(F.col("id") % 6000).cast("int"))).alias("ts"),
        (F.col("id") % 97).cast("double").alias("open"), (F.col("id") % 97 + 2).cast("double").alias("high"),
        (F.col("id") % 97 - 2).cast("double").alias("low"), (F.col("id") % 89).cast("double").alias("close"), F.lit(3.0).alias("volume"))
    start = datetime(2024, 1, 1)
    wanted = [("s0", start + timedelta(hours=2000)), ("s0", start + timedelta(hours=3010)), ("s1", start + timedelta(hours=2100)),
              ("s1", start + timedelta(hours=2900))]
    return bars, spark.createDataFrame(wanted, "series string, ts timestamp_ntz")


def test_few_targets_read_the_bars_they_need(spark, tmp_path):
    bars, targets = far_apart(spark)
    bars.write.parquet(str(tmp_path / "bars"))
    stored = spark.read.parquet(str(tmp_path / "bars"))
    near = w.reached(stored, targets, 100)
    kept = {(r.series, r.ts) for r in near.collect()}
    for t in targets.collect():
        for h in range(101):
            there = (t.series, t.ts - timedelta(hours=h))
            assert there in kept or stored.where((F.col("series") == t.series) & (F.col("ts") == there[1])).isEmpty()
    assert len(kept) <= 2 * 101 * 4
    spec = ind.IndicatorSpec(sma=(5,), rsi=4, macd=(3, 6), volume_ma=5)
    made = ind.recompute_features(stored, targets, 96, 6, ["1H", "4H", "1D"], spec)
    shown = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = made._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", shown)
    scans = re.findall(r"FileScan parquet .*?PushedFilters: \[(.*?)\]", plan)
    assert scans and all("GreaterThanOrEqual(ts" in s and "LessThanOrEqual(ts" in s for s in scans)
    got = {(r.series, r.ts): r for r in made.collect()}
    assert len(got) == 3  # the target ten hours after a gap has no whole history
    whole = ind.recompute_features(bars, targets, 96, 6, ["1H", "4H", "1D"], spec, require_gapless=False)
    for r in whole.where("ts <> '2024-05-05 10:00:00'").collect():
        assert list(got[r.series, r.ts])[2:] == [x if x is None else pytest.approx(x) for x in list(r)[2:]]


def test_lookback_within_reach(spark):
    bars, targets = far_apart(spark)
    near = w.lookback(bars, targets, 48, ["1H", "4H"], reach_hours=54)
    full = w.lookback(bars, targets, 48, ["1H", "4H"])
    rows = lambda df: {tuple(r) for r in df.where("ts <> '2024-05-05 10:00:00'").collect()}
    assert rows(near) == rows(full)
    over_gap = "timeframe = '1H' and ts = '2024-05-05 10:00:00'"
    assert full.where(over_gap).count() == near.where(over_gap).count() == 48
    short = w.lookback(bars, targets, 48, ["1H"], reach_hours=47).groupBy("ts").count().collect()
    assert {r["count"] for r in short if r.ts != datetime(2024, 5, 5, 10)} == {48} and min(r["count"] for r in short) == 47
    assert w.lookback(bars, targets.limit(0), 48, ["1H"], reach_hours=47).count() == 0


def test_no_labels_are_an_error_when_asked(hourly, bars_of):
    bars = bars_of(hourly(30))
    for start, end, what in (("2025-01-01", None, "no bars from"), ("2023-12-31 20:00", "2023-12-31 22:00", "no bars from .* to"),
                             ("2024-01-02 04:00", "2024-01-02 05:00", "no labels")):
        assert w.generate_targets(bars, start=start, end=end, horizon=6).count() == 0
        with pytest.raises(w.NoTargets, match=what):
            w.generate_targets(bars, start=start, end=end, horizon=6, on_empty="fail")
    assert w.generate_targets(bars, start="2024-01-01", horizon=6, on_empty="fail").count() == 24


@pytest.mark.parametrize("need", [None, 1, 4])
def test_forward_return_against_a_loop(hourly, bars_of, need):
    pdf = hourly(40, drop=[7, 8])
    pdf.loc[pdf.index[20], "close"] = None
    got = {r.ts: r.y_true for r in w.forward_return(bars_of(pdf), 6, min_forward=need, chunk_hours=9, block_rows=11).collect()}
    rows = pdf.sort_values("ts").reset_index(drop=True)
    want = {}
    for i in range(len(rows)):
        ahead = rows.close.iloc[i + 1:i + 7]
        if len(ahead) >= (need or 6) and not np.isnan(rows.close[i]) and not np.isnan(ahead.iloc[-1]):
            want[rows.ts[i].to_pydatetime()] = np.log(ahead.iloc[-1] / rows.close[i])
    assert got == {t: pytest.approx(y) for t, y in want.items()}
