"""Queries: choosing target bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import targets as t
from suite.base import CUTOFF, NOW, bars, features, predictions, query


@query("T1_closed_bars", "bars", f"""
    SELECT series, ts, close FROM bars
    WHERE ts BETWEEN timestamp '2024-01-05 00:00:00' AND timestamp '2024-01-25 00:00:00'
      AND ts <= timestamp '{CUTOFF}'""")
def closed_bars(spark, sf):
    return t.closed_bars(bars(spark, sf), NOW, "2024-01-05", "2024-01-25").select("series", "ts", "close")


@query("T2_select_window", "bars", f"""
    SELECT 'none' AS bounds, series, ts FROM bars
    WHERE ts BETWEEN timestamp '{CUTOFF}' - interval '48' hour AND timestamp '{CUTOFF}'
    UNION ALL
    SELECT 'start', series, ts FROM bars WHERE ts BETWEEN timestamp '2024-01-10 00:00:00' AND timestamp '{CUTOFF}'
    UNION ALL
    SELECT 'end', series, ts FROM bars
    WHERE ts BETWEEN timestamp '2024-01-10 00:00:00' AND timestamp '2024-01-12 00:00:00'""")
def select_window(spark, sf):
    b = bars(spark, sf).select("series", "ts")
    cases = {"none": (None, None), "start": ("2024-01-10", None), "end": (None, "2024-01-12")}
    out = [t.select_window(b, NOW, *bounds).select(F.lit(n).alias("bounds"), "series", "ts")
           for n, bounds in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("T3_select_incremental", "bars predictions", f"""
    SELECT b.series, b.ts, m.model_path
    FROM bars b CROSS JOIN (VALUES ('m1'), ('m9')) AS m(model_path)
    LEFT JOIN (SELECT series, model_path, max(ts) AS last_ts FROM predictions GROUP BY series, model_path) p
      ON p.series = b.series AND p.model_path = m.model_path
    WHERE b.ts <= timestamp '{CUTOFF}'
      AND b.ts >= coalesce(p.last_ts + interval '1' hour, timestamp '{CUTOFF}' - interval '48' hour)""")
def select_incremental(spark, sf):
    b = bars(spark, sf).select("series", "ts")
    return t.select_incremental(b, predictions(spark, sf), ["m1", "m9"], NOW, series=["series"])


@query("T4_select_ts_list", "bars", f"""
    SELECT b.series, b.ts FROM bars b
    WHERE b.ts IN (SELECT date_trunc('day', o_orderdate) + interval '10602' day
                   FROM orders) AND b.ts <= timestamp '{CUTOFF}'""")
def select_ts_list(spark, sf):
    days = spark.read.parquet(f"{sf}/orders.parquet").select(
        (F.to_date("o_orderdate").cast("timestamp_ntz") + F.expr("interval 10602 days")).alias("ts"))
    return t.select_ts_list(bars(spark, sf).select("series", "ts"), days, NOW)


@query("T5_at_most", "bars", """
    SELECT series, ts, close FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM bars) WHERE rn <= 40""")
def at_most(spark, sf):
    return t.at_most(bars(spark, sf).select("series", "ts", "close"), 40, ["ts"], ["series"])


@query("T6_recent_n", "predictions", """
    SELECT series, ts, y_pred, model_path, feature_key, created_at FROM predictions
    ORDER BY ts DESC, series LIMIT 25""")
def recent_n(spark, sf):
    rows = predictions(spark, sf).select("series", "ts", "y_pred", "model_path", "feature_key", "created_at")
    return t.recent_n(rows, 25, [F.desc("ts"), F.asc("series")])


@query("T7_csv_targets", "bars predictions", """
    WITH src AS (SELECT DISTINCT ts AS "timestamp" FROM bars)
    SELECT 'list' AS how, "timestamp" FROM (
      SELECT "timestamp" FROM src WHERE "timestamp" IN (SELECT ts FROM predictions) ORDER BY 1 LIMIT 7)
    UNION ALL
    SELECT 'range', "timestamp" FROM (
      SELECT "timestamp" FROM src WHERE "timestamp" >= timestamp '2024-01-03 12:00:00' ORDER BY 1 LIMIT 6)
    UNION ALL
    SELECT 'tail', "timestamp" FROM (SELECT "timestamp" FROM src ORDER BY 1 DESC LIMIT 5)""")
def csv_targets(spark, sf):
    src = bars(spark, sf).select(F.col("ts").alias("timestamp")).distinct()
    cases = {
        "list": t.csv_targets(src, stamps=predictions(spark, sf), limit=7),
        "range": t.csv_targets(src, start="2024-01-03 12:00:00", limit=6),
        "tail": t.csv_targets(src, limit=5),
    }
    out = [df.select(F.lit(n).alias("how"), "timestamp") for n, df in cases.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("T8_random_n", "predictions", """
    SELECT series, ts, y_pred FROM predictions
    ORDER BY md5(concat_ws('|', series, strftime(ts, '%Y-%m-%d %H:%M:%S'), '42')), series, ts LIMIT 30""")
def random_n(spark, sf):
    return t.random_n(predictions(spark, sf), 30, 42).select("series", "ts", "y_pred")


@query("T9_evenly_spaced_n", "bars", """
    SELECT series, ts, close FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) - 1 AS pos,
             count(*) OVER (PARTITION BY series) AS n FROM bars)
    WHERE pos IN (SELECT (i * (n - 1)) // 11 FROM range(12) r(i))""")
def evenly_spaced_n(spark, sf):
    return t.evenly_spaced_n(bars(spark, sf).select("series", "ts", "close"), 12)


@query("T10_range_filter", "bars", """
    SELECT series, ts, open, volume FROM bars
    WHERE ts >= timestamp '2024-01-08 06:00:00' AND ts <= timestamp '2024-01-09 18:00:00'""")
def range_filter(spark, sf):
    b = bars(spark, sf).select("series", "ts", "open", "volume")
    return t.in_range(b, "ts", "2024-01-08T08:00:00+02:00", "2024-01-09 18:00:00")


@query("T11_key_filter", "features", """
    SELECT 'v2' AS asked, feature_key, series, ts FROM features WHERE feature_key = 'v2'
    UNION ALL SELECT 'all', feature_key, series, ts FROM features""")
def key_filter(spark, sf):
    f = features(spark, sf).select("feature_key", "series", "ts")
    one = t.key_filter(f, "v2").select(F.lit("v2").alias("asked"), "*")
    return one.unionByName(t.key_filter(f, "").select(F.lit("all").alias("asked"), "*"))


@query("T12_preds_for", "predictions bars", """
    SELECT series, ts, y_pred FROM predictions
    WHERE feature_key = 'v1' AND model_path = 'm1' AND ts IN (SELECT ts FROM bars WHERE volume > 300)""")
def preds_for(spark, sf):
    wanted = bars(spark, sf).where("volume > 300")
    return t.scores_for(predictions(spark, sf), wanted, "v1", "m1").select("series", "ts", "y_pred")


@query("T13_signals", "predictions", "SELECT series, ts, y_pred FROM predictions WHERE y_pred > 0")
def signals(spark, sf):
    return t.signals(predictions(spark, sf)).select("series", "ts", "y_pred")
