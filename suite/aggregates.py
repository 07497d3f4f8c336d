"""Queries: table statistics and diff summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.scans import positions
from barline.operators import compare as c
from barline.operators import joins as j
from barline.operators import stats as s
from barline.operators import targets as t
from barline.operators.series import resample_bars
from suite.base import bars, bars_b, features, predictions, predictions_b, query, r6, rq, table


@query("A1_table_stats", "predictions", """
    SELECT count(*) AS n_rows, min(ts) AS ts_min, max(ts) AS ts_max, min(created_at) AS created_at_min,
           max(created_at) AS created_at_max FROM predictions""")
def table_stats(spark, sf):
    return s.table_stats(predictions(spark, sf))


@query("A2_time_window_stats", "features", """
    SELECT min(ts) AS min_time, max(ts) AS max_time, count(*) AS row_count,
           cast(date_diff('second', min(ts), max(ts)) AS bigint) AS duration_seconds FROM features""")
def time_window_stats(spark, sf):
    return s.time_window_stats(features(spark, sf))


@query("A3_distinct_ts_stats", "features", """
    SELECT count(DISTINCT ts) AS n_ts, min(ts) AS ts_min, max(ts) AS ts_max FROM features
    WHERE ts >= timestamp '2024-01-04 00:00:00' AND ts <= timestamp '2024-01-24 00:00:00'""")
def distinct_ts_stats(spark, sf):
    return s.distinct_ts_stats(t.in_range(features(spark, sf), "ts", "2024-01-04", "2024-01-24"))


@query("A4_rows_per_feature_key", "features",
       "SELECT feature_key, count(*) AS n FROM features GROUP BY feature_key ORDER BY feature_key")
def rows_per_feature_key(spark, sf):
    return s.rows_per_key(features(spark, sf))


@query("A5_last_prediction_ts", "predictions", """
    SELECT series, model_path, max(ts) AS last_ts FROM predictions WHERE dataset = 'base'
    GROUP BY series, model_path""")
def last_prediction_ts(spark, sf):
    return t.last_scored(predictions(spark, sf), "base", ["series", "model_path"])


@query("A6_duplicate_keys", "", """
    SELECT l_orderkey, l_linenumber, count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1 ORDER BY c DESC, l_orderkey, l_linenumber LIMIT 5""")
def duplicate_keys(spark, sf):
    return j.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 5)


_STATS = """count(*) AS n_rows, count(*) FILTER (diff IS NULL OR diff <> 0) AS n_diff,
    {mean} AS mean_diff, {lo} AS min_diff, {hi} AS max_diff, {std} AS std_diff, {med} AS median_diff"""


def _stats(diff: str) -> str:
    return _STATS.format(mean=rq(f"avg({diff})"), lo=rq(f"min({diff})"), hi=rq(f"max({diff})"),
                         std=rq(f"stddev_pop({diff})"), med=rq(f"median({diff})"))


_PAIRS = """
    p AS (SELECT series, ts, unnest(['open','high','low','close','volume']) AS "column",
      unnest([a.open - b.open, a.high - b.high, a.low - b.low, a.close - b.close, a.volume - b.volume]) AS diff
      FROM bars a JOIN bars_b b USING (series, ts))"""


def _rounded(df):
    return df.withColumns({f"{n}_diff": r6(f"{n}_diff") for n in ("mean", "min", "max", "std", "median")})


@query("A7_diff_stats_nonzero", "bars bars_b", f"""
    WITH {_PAIRS} SELECT "column", {_stats("CASE WHEN diff <> 0 THEN diff END")} FROM p GROUP BY "column" """)
def diff_stats_nonzero(spark, sf):
    pairs = c.long_pairs(bars(spark, sf), bars_b(spark, sf), ["open", "high", "low", "close", "volume"])
    return _rounded(c.diff_stats_nonzero(pairs))


@query("A7_diff_stats_nonzero_lines", "", f"""
    WITH o AS (SELECT o_orderkey, o_totalprice FROM orders),
    d AS (SELECT l_returnflag AS "column", l_extendedprice - o_totalprice AS diff
          FROM lineitem JOIN o ON l_orderkey = o_orderkey)
    SELECT "column", {_stats("CASE WHEN diff <> 0 THEN diff END")} FROM d GROUP BY "column" """)
def diff_stats_lines(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    diff = F.col("l_extendedprice") - F.col("o_totalprice")
    pairs = table(spark, sf, "lineitem").join(o, "l_orderkey").select(F.col("l_returnflag").alias("column"),
                                                                       diff.alias("diff"))
    return _rounded(c.diff_stats_nonzero(pairs))


@query("A8_diff_stats_all", "predictions predictions_b", f"""
    SELECT {_stats("diff")} FROM (SELECT a.y_pred - b.y_pred AS diff
      FROM predictions a JOIN predictions_b b USING (series, ts, model_path))""")
def diff_stats_all(spark, sf):
    return _rounded(c.diff_stats_all(c.score_pairs(predictions(spark, sf), predictions_b(spark, sf))))


@query("A9_win_rate", "bars predictions", f"""
    WITH s AS (SELECT * FROM predictions WHERE y_pred > 0),
    o AS (SELECT s.series, sign(CASE WHEN o.open > 0 AND c.close > 0 THEN ln(c.close / o.open) END) AS sg
      FROM s JOIN bars t ON t.series = s.series AND t.ts = s.ts
      JOIN bars o ON o.series = s.series AND o.ts = s.ts + interval '1' hour
      JOIN bars c ON c.series = s.series AND c.ts = s.ts + interval '24' hour)
    SELECT x.series, x.signals, coalesce(y.evaluated, 0) AS evaluated, coalesce(y.wins, 0) AS wins,
      coalesce(y.evaluated, 0) - coalesce(y.wins, 0) AS losses, {rq("y.wins * 100.0 / nullif(y.evaluated, 0)")} AS win_rate
    FROM (SELECT series, count(*) AS signals FROM s GROUP BY series) x LEFT JOIN
      (SELECT series, count(*) AS evaluated, count(*) FILTER (sg > 0) AS wins FROM o GROUP BY series) y
      ON x.series = y.series""")
def win_rate(spark, sf):
    signal_rows = t.signals(predictions(spark, sf))
    outcomes = j.shifted_outcome(signal_rows, bars(spark, sf))
    return s.win_rate(signal_rows, outcomes, ["series"]).withColumn("win_rate", r6("win_rate"))


def _resampled(tf: str, hours_: int) -> str:
    return f"""SELECT '{tf}' AS timeframe, series,
      time_bucket(interval '{hours_}' hour, ts, timestamp '1970-01-01') AS bar_ts,
      arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close,
      {rq("sum(volume)")} AS volume FROM bars GROUP BY ALL"""


@query("A10_resample_bars", "bars", " UNION ALL ".join(
    _resampled(tf, h) for tf, h in (("1H", 1), ("4H", 4), ("12H", 12), ("1D", 24))))
def resample(spark, sf):
    out = None
    for tf in ("1H", "4H", "12H", "1D"):
        made = resample_bars(bars(spark, sf), tf).withColumnRenamed("ts", "bar_ts").withColumn("volume", r6("volume"))
        made = made.select(F.lit(tf).alias("timeframe"), "*")
        out = made if out is None else out.unionByName(made)
    return out


@query("A11_max_abs_diff", "bars bars_b", f"""
    SELECT {rq("max(abs(a.close - b.close))")} AS max_abs_diff FROM bars a JOIN bars_b b USING (series, ts)""")
def max_abs_diff(spark, sf):
    a, b = (df.select("series", "ts", "close") for df in (bars(spark, sf), bars_b(spark, sf)))
    both = j.join_on_ts(a, b)
    return s.max_abs_diff(both, F.col("close_a"), F.col("close_b")).select(r6("max_abs_diff").alias("max_abs_diff"))


@query("A12_models_per_ts", "predictions", """
    SELECT series, ts, count(*) AS n, count(*) >= 3 AS enough
    FROM (SELECT series, ts FROM predictions WHERE feature_key = 'v1'
          UNION ALL SELECT series, ts FROM predictions WHERE feature_key = 'v1' AND y_pred > 0
          UNION ALL SELECT series, ts FROM predictions WHERE feature_key = 'v1' AND y_pred > 0)
    GROUP BY series, ts""")
def models_per_ts(spark, sf):
    from barline.operators.store import add_models

    base = predictions(spark, sf)
    more = add_models(base.where("y_pred > 0"), ["x1", "x2"])
    return s.models_per_ts(base.unionByName(more), "v1")


@query("A13_distinct_model_paths", "predictions", """
    SELECT DISTINCT concat(model_path, '/', series) AS model_path FROM predictions""")
def distinct_model_paths(spark, sf):
    named = predictions(spark, sf).withColumn("model_path", F.concat_ws("/", "model_path", "series"))
    return s.distinct_model_paths(named)


@query("A14_diff_summary", "predictions predictions_b", f"""
    SELECT {rq("max(d)")} AS max_diff, {rq("avg(d)")} AS mean_diff, count(*) FILTER (d > 0) AS n_nonzero, count(*) AS n
    FROM (SELECT abs(a.y_pred - b.y_pred) AS d FROM predictions a JOIN predictions_b b USING (series, ts, model_path))""")
def diff_summary(spark, sf):
    pairs = c.score_pairs(predictions(spark, sf), predictions_b(spark, sf))
    out = s.diff_summary(pairs, F.col("a"), F.col("b"))
    return out.withColumns({n: r6(n) for n in ("max_diff", "mean_diff")})


@query("A3_bars_per_position", "bars", """
    SELECT pos, count(*) AS n FROM (
      SELECT row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos FROM bars) GROUP BY pos""")
def bars_per_position(spark, sf):
    placed = positions(bars(spark, sf).select("series", "ts"), ["series"], ["ts"], name="pos", chunk_hours=72)
    return placed.groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
