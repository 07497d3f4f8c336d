"""Choosing which bars to work on.

A bar is closed once its hour has passed: its time is at most
``floor_hour(now) - 1h``. ``now`` is always a parameter, so a run can be
repeated exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import hours, naive_utc, ts_lit
from barline.functions.scans import DEFAULT_CHUNK_HOURS, positions
from barline.sources.tables import in_range

DEFAULT_WINDOW_HOURS = 48

Stamp = str | datetime | pd.Timestamp


def cutoff(now: Stamp) -> pd.Timestamp:
    return naive_utc(now).floor("h") - pd.Timedelta(hours=1)


def closed_bars(bars: DataFrame, now: Stamp, start: Stamp | None = None, end: Stamp | None = None,
                ts: str = "ts") -> DataFrame:
    """Closed bars in ``[start, end]``, both ends inclusive."""
    return in_range(bars, ts, start, end).where(F.col(ts) <= ts_lit(cutoff(now)))


def window_bounds(now: Stamp, start: Stamp | None = None, end: Stamp | None = None,
                  hours_back: int = DEFAULT_WINDOW_HOURS) -> tuple[pd.Timestamp, pd.Timestamp]:
    last = naive_utc(end) if end else cutoff(now)
    first = naive_utc(start) if start else last - pd.Timedelta(hours=hours_back)
    return first, last


def select_window(bars: DataFrame, now: Stamp, start: Stamp | None = None, end: Stamp | None = None,
                  ts: str = "ts") -> DataFrame:
    """Closed bars of a window; without bounds the last 48 hours (49 bars)."""
    first, last = window_bounds(now, start, end)
    return closed_bars(bars, now, first, last, ts)


def last_scored(scores: DataFrame, dataset: str | None = None, keys: Sequence[str] = ("model_path",)) -> DataFrame:
    """Newest scored time per model. A store without a ``dataset`` column has
    nothing scored for any dataset."""
    if dataset:
        if "dataset" not in scores.columns:
            scores = scores.where(F.lit(False))
        else:
            scores = scores.where(F.col("dataset") == dataset)
    return scores.groupBy(*keys).agg(F.max("ts").alias("last_ts"))


def incremental_start(last: DataFrame, now: Stamp, end: Stamp | None = None) -> pd.Timestamp:
    """The earliest time an incremental run can need: after the oldest of the
    newest scores (``last_ts``), and no later than the start of a model without
    scores. One row comes to the driver."""
    fallback = (naive_utc(end) if end else cutoff(now)) - pd.Timedelta(hours=DEFAULT_WINDOW_HOURS)
    lowest = last.agg(F.min("last_ts")).first()[0]
    return fallback if lowest is None else min(fallback, pd.Timestamp(lowest) + pd.Timedelta(hours=1))


def select_incremental(bars: DataFrame, scores: DataFrame, models: Sequence[str], now: Stamp,
                       end: Stamp | None = None, dataset: str | None = None, series: Sequence[str] = (),
                       earliest: Stamp | None = None) -> DataFrame:
    """Closed bars after each model's newest score: one row per bar and model.

    A model without scores starts 48 hours before the end. With ``series``
    keys the newest score is taken per series and model. Bars are read once for
    all models. ``scores`` may be the marks of a store
    (:meth:`barline.operators.store.Store.high_water`): only newest times count.

    The earliest of the starts bounds the scan of the bars, and of whatever is
    joined to the result by time. Where the caller does not give it, it is looked up first, which runs a job.
    """
    series = list(series)
    end_ts = naive_utc(end) if end else cutoff(now)
    last = last_scored(scores.where(F.col("model_path").isin(list(models))), dataset, [*series, "model_path"])
    begin_scan = naive_utc(earliest) if earliest is not None else incremental_start(last, now, end)
    candidates = closed_bars(bars, now, begin_scan, end_ts).withColumn(
        "model_path", F.explode(F.array(*[F.lit(m) for m in models])))
    bounded = candidates.join(last, [*series, "model_path"], "left")
    begin = F.coalesce(F.col("last_ts") + hours(1), ts_lit(end_ts - pd.Timedelta(hours=DEFAULT_WINDOW_HOURS)))
    return bounded.where(F.col("ts") >= begin).drop("last_ts")


def select_ts_list(bars: DataFrame, stamps: DataFrame, now: Stamp, ts: str = "ts") -> DataFrame:
    """Closed bars whose time is in ``stamps`` (column ``ts``)."""
    wanted = stamps.select(F.col("ts").alias(ts)).distinct()
    return closed_bars(bars, now, ts=ts).join(wanted, [ts], "left_semi")


def at_most(df: DataFrame, n: int | None, order: Sequence[str] = ("ts",), keys: Sequence[str] = ()) -> DataFrame:
    """The earliest ``n`` rows (per ``keys``); no limit for None or n <= 0."""
    if n is None or n <= 0:
        return df
    if not keys:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def recent_n(df: DataFrame, n: int, order: Sequence[Column] | None = None) -> DataFrame:
    """The newest ``n`` rows, newest first."""
    return df.orderBy(*(order or [F.desc("ts")])).limit(n)


def csv_targets(source: DataFrame, *, stamps: DataFrame | None = None, start: Stamp | None = None,
                end: Stamp | None = None, limit: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Times to compare: a list met with the source, or the head of a range, or
    the newest ones; ``limit`` of them, all when not given."""
    times = source.select(ts)
    if stamps is not None:
        times = times.join(stamps.select(F.col("ts").alias(ts)).distinct(), [ts], "left_semi").distinct()
        return at_most(times, limit, [ts])
    if start is not None or end is not None:
        return at_most(in_range(times, ts, start, end), limit, [ts])
    return recent_n(times, limit, [F.desc(ts)]) if limit else times


def random_n(df: DataFrame, n: int, seed: int, key: Sequence[str] = ("series", "ts")) -> DataFrame:
    """``n`` rows without replacement, the same for the same seed.

    Rows are ordered by a hash of their key and the seed, so the choice does
    not depend on how the data is partitioned.
    """
    draw = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return df.withColumn("_draw", draw).orderBy("_draw", *key).limit(n).drop("_draw")


def evenly_spaced_n(df: DataFrame, n: int, keys: Sequence[str] = ("series",), order: Sequence[str] = ("ts",),
                    chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """``n`` rows per key at positions ``floor(i*(N-1)/(n-1))`` in time order."""
    keys = list(keys)
    placed = positions(df, keys, order, chunk_hours=chunk_hours)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    steps = sizes.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1))))
    spot = F.expr(f"cast(_i as bigint) * (_total - 1) div {max(n - 1, 1)}")
    wanted = steps.select(*keys, spot.alias("_pos")).distinct()
    return placed.join(wanted, [*keys, "_pos"], "left_semi").drop("_pos")


def key_filter(df: DataFrame, feature_key: str | None) -> DataFrame:
    """Rows of one feature key; None or an empty key keeps all."""
    return df.where(F.col("feature_key") == feature_key) if feature_key else df


def scores_for(scores: DataFrame, stamps: DataFrame, feature_key: str | None = None,
               model_path: str | None = None) -> DataFrame:
    """Scores at the given times, for one model and feature key."""
    rows = key_filter(scores, feature_key)
    if model_path:
        rows = rows.where(F.col("model_path") == model_path)
    return rows.join(stamps.select("ts").distinct(), ["ts"], "left_semi")


def signals(scores: DataFrame) -> DataFrame:
    return scores.where(F.col("y_pred") > 0)
