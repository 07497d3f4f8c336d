"""Table statistics and outcome summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.targets import key_filter


def table_stats(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("ts_min"), F.max("ts").alias("ts_max"),
        F.min("created_at").alias("created_at_min"), F.max("created_at").alias("created_at_max"))


def time_window_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    """First and last time, row count, and the span in seconds."""
    bounds = df.agg(F.min(ts).alias("min_time"), F.max(ts).alias("max_time"), F.count(F.lit(1)).alias("row_count"))
    span = F.unix_seconds(F.col("max_time").cast("timestamp")) - F.unix_seconds(F.col("min_time").cast("timestamp"))
    return bounds.withColumn("duration_seconds", span)


def distinct_ts_stats(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Number of distinct times, first and last.

    Times are made distinct by a two-step aggregation, so no task holds a set.
    """
    return df.select(ts).distinct().agg(F.count(ts).alias("n_ts"), F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"))


def rows_per_key(df: DataFrame, keys: Sequence[str] = ("feature_key",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys)


def models_per_ts(scores: DataFrame, feature_key: str | None = None, keys: Sequence[str] = ("series", "ts"),
                  at_least: int = 3) -> DataFrame:
    """Rows per key and whether there are at least ``at_least``."""
    counted = key_filter(scores, feature_key).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("enough", F.col("n") >= at_least)


def distinct_model_paths(scores: DataFrame) -> DataFrame:
    return scores.select("model_path").distinct()


def win_rate(signal_rows: DataFrame, outcomes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Signals, evaluated signals, wins, losses and win rate in percent.

    ``signal_rows`` are all signals, ``outcomes`` those with an outcome. A
    missing outcome is no win, hence a loss.
    """
    keys = list(keys)
    total = signal_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("signals"))
    done = outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("evaluated"), F.count_if(F.col("outcome_sign") > 0).alias("wins"))
    if keys:
        both = total.join(done, keys, "left")
    else:
        both = total.withColumn("_k", F.lit(1)).join(done.withColumn("_k", F.lit(1)), "_k", "left").drop("_k")
    both = both.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("evaluated", "wins")})
    rate = F.col("wins") * 100.0 / F.nullif(F.col("evaluated"), F.lit(0))
    return both.withColumn("losses", F.col("evaluated") - F.col("wins")).withColumn("win_rate", rate)


def max_abs_diff(joined: DataFrame, a: Column, b: Column) -> DataFrame:
    return joined.agg(F.max(F.abs(a - b)).alias("max_abs_diff"))


def diff_summary(joined: DataFrame, a: Column, b: Column) -> DataFrame:
    """Over finite differences: largest, mean, non-zero count and count."""
    diff = F.abs(a - b)
    diffs = joined.select(F.when(~F.isnan(diff) & (diff < float("inf")), diff).alias("d")).where("d is not null")
    return diffs.agg(F.max("d").alias("max_diff"), F.avg("d").alias("mean_diff"),
                     F.count_if(F.col("d") > 0).alias("n_nonzero"), F.count(F.lit(1)).alias("n"))
