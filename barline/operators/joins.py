"""Joins and set operations on (series, time).

All joins are equi-joins on series and time, so a long series spreads over
tasks by its times. Nothing is broadcast by hint: Spark broadcasts a side when
its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import epoch_micros, hours
from barline.functions.scans import running
from barline.operators.targets import key_filter
from barline.session import cut, stack

SERIES_TS = ("series", "ts")


def existing_bars(targets: DataFrame, bars: DataFrame, on: Sequence[str] = SERIES_TS) -> DataFrame:
    return targets.join(bars.select(*on), list(on), "left_semi")


def existing_features(targets: DataFrame, features: DataFrame, feature_key: str | None = None,
                      on: Sequence[str] = SERIES_TS) -> DataFrame:
    stored = key_filter(features, feature_key).select(*on)
    return targets.join(stored, list(on), "left_semi")


def consistency(targets: DataFrame, bars: DataFrame, features: DataFrame, feature_key: str | None = None,
                on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Status per target: ``ok``, ``missing_features``, ``missing_bar``.

    Targets with neither a bar nor features are left out. Both stores are cut
    down to the targets by a semi-join first, and all joins share one
    partitioning on series and time.
    """
    on = list(on)
    wanted = targets.select(*on).distinct()
    stored = bars.select(*on).join(wanted, on, "left_semi").distinct().withColumn("_b", F.lit(True))
    known = (key_filter(features, feature_key).select(*on).join(wanted, on, "left_semi").distinct()
             .withColumn("_f", F.lit(True)))
    seen = wanted.join(stored, on, "left").join(known, on, "left").where("_b or _f")
    status = (F.when(F.col("_b") & F.col("_f"), "ok").when(F.col("_b"), "missing_features").otherwise("missing_bar"))
    return seen.select(*on, status.alias("status"))


class InconsistentData(ValueError):
    """Bars and features of the targets do not match."""


def consistency_gate(targets: DataFrame, bars: DataFrame, features: DataFrame, feature_key: str | None = None,
                     on: Sequence[str] = SERIES_TS, sample: int = 10) -> DataFrame:
    """Targets with both a bar and features; raises when any lacks one of them.

    This is an action: it counts the statuses and, on failure, fetches the
    first ``sample`` offenders for the message.
    """
    checked = consistency(targets, bars, features, feature_key, on)
    counts = {r.status: r.n for r in checked.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    for status in ("missing_features", "missing_bar"):
        if counts.get(status):
            first = checked.where(F.col("status") == status).orderBy(*[F.col(c) for c in reversed(on)]).limit(sample)
            listed = [tuple(r[c] for c in on) for r in first.collect()]
            raise InconsistentData(f"{counts[status]} targets with {status}; first: {listed}")
    return checked.where("status = 'ok'").select(*on)


def skip_existing(targets: DataFrame, scores: DataFrame, on: Sequence[str] = ("series", "ts", "model_path")
                  ) -> DataFrame:
    """Targets without a score. Dataset and feature key do not count."""
    return targets.join(scores.select(*on), list(on), "left_anti")


def join_on_ts(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS, suffixes: tuple[str, str] = ("_a", "_b")
               ) -> DataFrame:
    """Inner join; columns both sides have get suffixes, duplicates multiply."""
    shared = (set(a.columns) & set(b.columns)) - set(on)
    left = a.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = b.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, list(on))


def shifted_outcome(scores: DataFrame, bars: DataFrame, series: Sequence[str] = ("series",), open_after: int = 1,
                    close_after: int = 24) -> DataFrame:
    """Outcome of entering at the next bar's open and leaving at a later close.

    The bars at ``ts``, ``ts + 1h`` and ``ts + 24h`` must all exist, by time.
    Adds the entry bar's ``high, low``, ``entry_open``, ``exit_close``,
    ``outcome`` (log return, NULL if not defined) and ``outcome_sign``.
    """
    on = [*series, "ts"]
    here = bars.select(*on, "high", "low")
    later = bars.select(*series, (F.col("ts") - hours(open_after)).alias("ts"), F.col("open").alias("entry_open"))
    exits = bars.select(*series, (F.col("ts") - hours(close_after)).alias("ts"), F.col("close").alias("exit_close"))
    joined = scores.join(here, on).join(later, on).join(exits, on)
    outcome = F.ln(F.col("exit_close") / F.nullif(F.col("entry_open"), F.lit(0.0)))
    return joined.withColumn("outcome", outcome).withColumn("outcome_sign", F.signum("outcome"))


def merge_wide(current: DataFrame, normalized: DataFrame, on: Sequence[str] = ("timestamp",), prefer: str = "cur"
               ) -> DataFrame:
    """Inner join; a column both sides have is kept from the preferred side."""
    if prefer not in ("cur", "norm"):
        raise ValueError("prefer must be 'cur' or 'norm'")
    overlap = [c for c in current.columns if c in normalized.columns and c not in on]
    if prefer == "cur":
        normalized = normalized.drop(*overlap)
    else:
        current = current.drop(*overlap)
    return current.join(normalized, list(on))


def latest_rows(df: DataFrame, keys: Sequence[str] = SERIES_TS, newest: str = "created_at") -> DataFrame:
    """All rows whose ``newest`` is the maximum of their key; ties stay."""
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc(newest)))
    return df.withColumn("_rk", rank).where("_rk = 1").drop("_rk")


class DuplicateKeys(ValueError):
    """A key that must be unique is not."""


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keys with more than one row, most frequent first."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return counted if limit is None else counted.orderBy(F.desc("c"), *keys).limit(limit)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    """Raise :class:`DuplicateKeys` with sample keys, else return ``df``."""
    found = duplicate_keys(df, keys, 5).collect()
    if found:
        raise DuplicateKeys(f"{what}: duplicate {list(keys)}, for example {[r.asDict() for r in found]}")
    return df


def join_one_to_one(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS,
                    suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Inner join after checking that keys are unique on both sides."""
    require_unique(a, on, "left side")
    require_unique(b, on, "right side")
    return join_on_ts(a, b, on, suffixes)


def nearest_ts(targets: DataFrame, stored: DataFrame, keys: Sequence[str] = ("series",), ts: str = "ts",
               out: str = "nearest_ts", chunk_hours: int | None = None) -> DataFrame:
    """The stored time closest to each target; the earlier one wins ties.

    Both sides are put on one time line, which is scanned in chunks for the
    stored time before and after each target. Targets may crowd in time, so
    the chunks are cut by quantiles unless a length is given.
    """
    keys = list(keys)
    line = stack(
        targets.select(*keys, ts, F.lit(True).alias("_target"), F.lit(None).cast("timestamp_ntz").alias("_s")),
        stored.select(*keys, ts, F.lit(False).alias("_target"), F.col(ts).alias("_s")),
    ).groupBy(*keys, ts).agg(F.max("_target").alias("_target"), F.max("_s").alias("_s"))
    line = cut(line)  # cut points, chunk ends and rows are three passes over it
    both = running(line, keys, [ts], lasts={"_before": F.col("_s")}, nexts={"_after": F.col("_s")},
                   chunk_hours=chunk_hours)
    back = epoch_micros(ts) - epoch_micros("_before")
    ahead = epoch_micros("_after") - epoch_micros(ts)
    pick = F.when(F.col("_after").isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    found = both.where("_target").select(*keys, ts, pick.alias(out))
    return targets.join(found, [*keys, ts], "left")


def ts_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return stack(a, b).distinct()


def ts_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b.select(*a.columns))


def ts_except(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b.select(*a.columns))


def coverage(a: DataFrame, b: DataFrame, values: Sequence[str], on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Rows of both sides with values side by side and a status column:
    ``common``, ``only_a``, ``only_b``."""
    on = list(on)
    left = a.select(*on, *[F.col(v).alias(f"{v}_a") for v in values], F.lit(True).alias("_a"))
    right = b.select(*on, *[F.col(v).alias(f"{v}_b") for v in values], F.lit(True).alias("_b"))
    status = (F.when(F.col("_a") & F.col("_b"), "common").when(F.col("_a"), "only_a").otherwise("only_b"))
    return left.join(right, on, "full_outer").withColumn("status", status).drop("_a", "_b")
