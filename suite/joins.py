"""Queries: joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import joins as j
from barline.operators.binning import assign_bins, bins_left_join, equal_count_bins
from barline.functions.columns import hours
from suite.base import bars, bars_b, features, predictions, predictions_b, query, r6, rq, scored_docs


def _shifted(spark, sf):
    """Times half of which fall on bars of the second feed: a day later."""
    return bars(spark, sf).select("series", (F.col("ts") + hours(24)).alias("ts"))


_SHIFTED = "SELECT series, ts + interval '24' hour AS ts FROM bars"


@query("J1_existing_bars", "bars bars_b", f"""
    SELECT t.series, t.ts FROM ({_SHIFTED}) t
    WHERE EXISTS (SELECT 1 FROM bars_b b WHERE b.series = t.series AND b.ts = t.ts)""")
def existing_bars(spark, sf):
    return j.existing_bars(_shifted(spark, sf), bars_b(spark, sf))


@query("J2_existing_features", "bars features", f"""
    SELECT t.series, t.ts FROM ({_SHIFTED}) t
    WHERE EXISTS (SELECT 1 FROM features f WHERE f.series = t.series AND f.ts = t.ts AND f.feature_key = 'v2')""")
def existing_features(spark, sf):
    return j.existing_features(_shifted(spark, sf), features(spark, sf), "v2")


@query("J3_consistency_gate", "bars bars_b features", f"""
    SELECT t.series, t.ts, CASE WHEN b.ts IS NOT NULL AND f.ts IS NOT NULL THEN 'ok'
      WHEN b.ts IS NOT NULL THEN 'missing_features' ELSE 'missing_bar' END AS status
    FROM ({_SHIFTED}) t
    LEFT JOIN bars_b b ON b.series = t.series AND b.ts = t.ts
    LEFT JOIN (SELECT DISTINCT series, ts FROM features WHERE feature_key = 'v1') f
      ON f.series = t.series AND f.ts = t.ts
    WHERE b.ts IS NOT NULL OR f.ts IS NOT NULL""")
def consistency_gate(spark, sf):
    return j.consistency(_shifted(spark, sf), bars_b(spark, sf), features(spark, sf), "v1")


@query("J3_gate", "bars bars_b features", f"""
    WITH s AS (SELECT t.series, t.ts, b.ts IS NOT NULL AS has_bar, f.ts IS NOT NULL AS has_features FROM ({_SHIFTED}) t
      LEFT JOIN bars_b b ON b.series = t.series AND b.ts = t.ts
      LEFT JOIN (SELECT DISTINCT series, ts FROM features WHERE feature_key = 'v1') f ON f.series = t.series AND f.ts = t.ts)
    SELECT series, ts, (SELECT bool_or(has_bar <> has_features) FROM s) AS refused FROM s WHERE has_bar AND has_features""")
def gate(spark, sf):
    """The gate lets consistent targets through, and refuses the whole set for one that lacks something."""
    asked, b, f = _shifted(spark, sf), bars_b(spark, sf), features(spark, sf)
    try:
        j.consistency_gate(asked, b, f, "v1")
        refused = False
    except j.InconsistentData:
        refused = True
    good = j.consistency(asked, b, f, "v1").where("status = 'ok'").select("series", "ts")
    return j.consistency_gate(good, b, f, "v1").withColumn("refused", F.lit(refused))


@query("J4_skip_existing", "bars predictions", """
    SELECT b.series, b.ts, 'm1' AS model_path FROM bars b
    WHERE NOT EXISTS (SELECT 1 FROM predictions p
                      WHERE p.series = b.series AND p.ts = b.ts AND p.model_path = 'm1')""")
def skip_existing(spark, sf):
    targets = bars(spark, sf).select("series", "ts", F.lit("m1").alias("model_path"))
    return j.skip_existing(targets, predictions(spark, sf))


@query("J5_join_on_ts", "bars bars_b", """
    SELECT a.series, a.ts, a.close AS close_a, b.close AS close_b FROM bars a JOIN bars_b b USING (series, ts)""")
def join_on_ts(spark, sf):
    a, b = (df.select("series", "ts", "close") for df in (bars(spark, sf), bars_b(spark, sf)))
    return j.join_on_ts(a, b)


@query("J6_shifted_outcome", "bars predictions", f"""
    SELECT p.series, p.ts, p.y_pred, o.open AS entry_open, c.close AS exit_close,
           {rq("CASE WHEN o.open > 0 AND c.close > 0 THEN ln(c.close / o.open) END")} AS outcome
    FROM predictions p JOIN bars t ON t.series = p.series AND t.ts = p.ts
    JOIN bars o ON o.series = p.series AND o.ts = p.ts + interval '1' hour
    JOIN bars c ON c.series = p.series AND c.ts = p.ts + interval '24' hour
    WHERE p.y_pred > 0""")
def shifted_outcome(spark, sf):
    out = j.shifted_outcome(predictions(spark, sf).where("y_pred > 0"), bars(spark, sf))
    return out.select("series", "ts", "y_pred", "entry_open", "exit_close", r6("outcome").alias("outcome"))


@query("J7_merge_wide", "bars bars_b", """
    SELECT a.series, a.ts, a.close, b.volume, a.high FROM
      (SELECT series, ts, close, high FROM bars) a JOIN (SELECT series, ts, close, volume FROM bars_b) b
      USING (series, ts)""")
def merge_wide(spark, sf):
    cur = bars(spark, sf).select("series", "ts", "close", "high")
    return j.merge_wide(cur, bars_b(spark, sf).select("series", "ts", "close", "volume"), ["series", "ts"])


@query("J7_merge_wide_orders", "", """
    SELECT o.o_orderkey AS k, o.o_totalprice, l.l_quantity, l.l_linenumber
    FROM orders o JOIN (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem) l ON l.l_orderkey = o.o_orderkey""")
def merge_wide_orders(spark, sf):
    cur = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_totalprice")
    norm = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("k"), F.lit(0.0).alias("o_totalprice"), "l_quantity", "l_linenumber")
    return j.merge_wide(cur, norm, ["k"], "cur")


@query("J8_latest_by_join", "features", """
    SELECT f.series, f.ts, f.feature_key, f.features FROM features f
    JOIN (SELECT series, ts, max(created_at) AS created_at FROM features GROUP BY series, ts) l
    USING (series, ts, created_at)""")
def latest_by_join(spark, sf):
    return j.latest_rows(features(spark, sf)).select("series", "ts", "feature_key", "features")


@query("J9_join_one_to_one", "predictions predictions_b", """
    SELECT a.series, a.ts, a.y_pred AS y_pred_a, b.y_pred AS y_pred_b
    FROM predictions a JOIN predictions_b b USING (series, ts, model_path)""")
def join_one_to_one(spark, sf):
    keys = ["series", "ts", "model_path"]
    a, b = (df.select(*keys, "y_pred") for df in (predictions(spark, sf), predictions_b(spark, sf)))
    return j.join_one_to_one(a, b, keys).drop("model_path")


@query("J10_nearest_ts", "bars", """
    WITH t AS (SELECT DISTINCT event_type AS series, ts FROM events),
    c AS (SELECT t.series, t.ts,
      (SELECT max(b.ts) FROM bars b WHERE b.series = t.series AND b.ts <= t.ts AND hour(b.ts) % 5 = 0) AS p,
      (SELECT min(b.ts) FROM bars b WHERE b.series = t.series AND b.ts >= t.ts AND hour(b.ts) % 5 = 0) AS n
      FROM t)
    SELECT series, ts, CASE WHEN n IS NULL OR ts - p <= n - ts THEN p ELSE n END AS nearest_ts FROM c""")
def nearest_ts(spark, sf):
    targets = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("series"), "ts").distinct()
    stored = bars(spark, sf).where(F.hour("ts") % 5 == 0)
    return j.nearest_ts(targets, stored)


@query("J11_bins_left_join", "scored_docs", f"""
    WITH r AS (SELECT doc_id, p, y, (row_number() OVER (ORDER BY p, doc_id) - 1) * 8 // count(*) OVER () AS bin
               FROM scored_docs),
    spec AS (SELECT bin, min(p) AS p_low, max(p) AS p_high, avg(p) AS p_center FROM r GROUP BY bin),
    a AS (SELECT r.doc_id, (SELECT count(*) FROM spec s WHERE s.p_high < r.p * 3) AS bin FROM r)
    SELECT cast(s.bin AS integer) AS bin, s.p_low, s.p_high, {rq("s.p_center")} AS p_center,
           cast(coalesce(c.n, 0) AS bigint) AS n
    FROM spec s LEFT JOIN (SELECT bin, count(*) AS n FROM a GROUP BY bin) c ON c.bin = s.bin""")
def bins_join(spark, sf):
    docs = scored_docs(spark, sf)
    spec = equal_count_bins(docs, "p", "doc_id", 8)
    used = assign_bins(docs.withColumn("p", F.col("p") * 3), "p", spec, "ignore").where("bin >= 0")
    joined = bins_left_join(spec, used.groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    return joined.withColumn("p_center", r6("p_center"))


@query("J12_ts_set_ops", "bars bars_b", """
    SELECT 'union' AS op, ts FROM (SELECT ts FROM bars UNION SELECT ts + interval '12' hour FROM bars_b)
    UNION ALL
    SELECT 'intersect', ts FROM (SELECT ts FROM bars INTERSECT SELECT ts + interval '12' hour FROM bars_b)
    UNION ALL
    SELECT 'except', ts FROM (SELECT ts FROM bars EXCEPT SELECT ts + interval '12' hour FROM bars_b)""")
def ts_set_ops(spark, sf):
    a = bars(spark, sf).select("ts")
    b = bars_b(spark, sf).select((F.col("ts") + hours(12)).alias("ts"))
    ops = {"union": j.ts_union, "intersect": j.ts_intersect, "except": j.ts_except}
    out = [op(a, b).select(F.lit(n).alias("op"), "ts") for n, op in ops.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("J13_coverage", "bars bars_b", """
    SELECT coalesce(a.series, b.series) AS series, coalesce(a.ts, b.ts) AS ts, a.close AS close_a, b.close AS close_b,
      CASE WHEN a.ts IS NOT NULL AND b.ts IS NOT NULL THEN 'common' WHEN a.ts IS NOT NULL THEN 'only_a'
           ELSE 'only_b' END AS status
    FROM bars a FULL OUTER JOIN (SELECT series, ts + interval '24' hour AS ts, close FROM bars_b) b
      ON a.series = b.series AND a.ts = b.ts""")
def coverage(spark, sf):
    later = bars_b(spark, sf).withColumn("ts", F.col("ts") + hours(24))
    return j.coverage(bars(spark, sf), later, ["close"])
