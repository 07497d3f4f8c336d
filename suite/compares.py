"""Queries: reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.columns import BAR_COLUMNS, all_close, hours
from barline.operators import compare as c
from barline.operators import series as w
from barline.operators.features import explode_features
from barline.operators.targets import key_filter
from suite.aggregates import _PAIRS, _rounded, _stats
from suite.base import bars, bars_b, features, features_b, predictions, predictions_b, query, r6, rq, table


@query("C1_compare_bars", "bars bars_b", f"""
    WITH {_PAIRS} SELECT "column", {_stats("CASE WHEN diff <> 0 THEN diff END")} FROM p GROUP BY "column" """)
def compare_bars(spark, sf):
    return _rounded(c.compare_bars(bars(spark, sf), bars_b(spark, sf)).drop("largest"))


@query("C2_compare_predictions", "predictions predictions_b", f"""
    SELECT series, {_stats("diff")} FROM (SELECT series, a.y_pred - b.y_pred AS diff
      FROM predictions a JOIN predictions_b b USING (series, ts, model_path)) GROUP BY series""")
def compare_predictions(spark, sf):
    return _rounded(c.compare_predictions(predictions(spark, sf), predictions_b(spark, sf), keys=["series"]).drop("largest"))


@query("C3_compare_features_wide", "bars bars_b", f"""
    SELECT 'close' AS "column", count(*) AS n_diff, {rq("avg(d)")} AS mean_diff, {rq("min(d)")} AS min_diff,
      {rq("max(d)")} AS max_diff, {rq("stddev_pop(d)")} AS std_diff, {rq("median(d)")} AS median_diff
    FROM (SELECT a.close - b.close AS d FROM bars a JOIN bars_b b USING (series, ts)) WHERE abs(d) > 1e-9""")
def features_wide(spark, sf):
    # y_move differs everywhere, but target columns are not compared. One-sided
    # values are no mismatch: open is missing at even hours of one side.
    a = bars(spark, sf).withColumn("y_move", F.col("close") - F.col("open"))
    b = bars_b(spark, sf).withColumn("y_move", F.lit(9.0)).withColumn(
        "open", F.when(F.hour("ts") % 2 == 1, F.col("open")))
    return _rounded(c.compare_features_wide(a, b).drop("largest"))


@query("C3_compare_lines_orders", "", f"""
    SELECT 'price' AS "column", count(*) AS n_diff, {rq("avg(d)")} AS mean_diff, {rq("min(d)")} AS min_diff,
      {rq("max(d)")} AS max_diff, {rq("stddev_pop(d)")} AS std_diff, {rq("median(d)")} AS median_diff
    FROM (SELECT l.p - o.p AS d FROM (SELECT l_orderkey, max(l_extendedprice) AS p FROM lineitem GROUP BY 1) l
          JOIN (SELECT o_orderkey, o_totalprice AS p FROM orders) o ON l_orderkey = o_orderkey) WHERE abs(d) > 0.5""")
def lines_orders(spark, sf):
    a = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("price"))
    b = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    return _rounded(c.compare_features_wide(a, b, ["k"], 0.5).drop("largest"))


def _listed(out, *keys):
    """One row per listed difference, with its place in the list."""
    rows = out.select(*keys, F.posexplode("largest").alias("place", "_r")).select(*keys, (F.col("place") + 1).cast("long").alias("place"), "_r.*")
    return rows.withColumns({x: r6(x) for x in ("a", "b", "diff")})


_TOP = """SELECT {keys}, place, {on}, {a} AS a, {b} AS b, {d} AS diff FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY abs(diff) DESC, {on}) AS place FROM ({rows}) WHERE diff <> 0) WHERE place <= 5"""


@query("C1_largest", "bars bars_b", _TOP.format(keys='"column"', on="ts, series", a=rq("a"), b=rq("b"), d=rq("diff"), rows=" UNION ALL ".join(
    f"""SELECT '{x}' AS "column", series, ts, a.{x} AS a, b.{x} AS b, a.{x} - b.{x} AS diff FROM bars a JOIN bars_b b USING (series, ts)"""
    for x in BAR_COLUMNS)))
def bars_largest(spark, sf):
    return _listed(c.compare_bars(bars(spark, sf), bars_b(spark, sf)), "column")


@query("C2_largest", "predictions predictions_b", _TOP.format(
    keys="series", on="ts", a=rq("a"), b=rq("b"), d=rq("diff"), rows="""SELECT series, ts, a.y_pred AS a, b.y_pred AS b,
      a.y_pred - b.y_pred AS diff FROM predictions a JOIN predictions_b b USING (series, ts, model_path)"""))
def predictions_largest(spark, sf):
    out = c.compare_predictions(predictions(spark, sf), predictions_b(spark, sf), on=("series", "ts", "model_path"), keys=["series"])
    listed = out.select(F.col("series").alias("_s"), F.transform("largest", lambda r: r.dropFields("series", "model_path")).alias("largest"))
    return _listed(listed, "_s").withColumnRenamed("_s", "series")


@query("C3_largest", "", _TOP.format(keys='"column"', on="k", a=rq("a"), b=rq("b"), d=rq("diff"), rows="""
      SELECT 'price' AS "column", o_orderkey AS k, l.p AS a, o_totalprice AS b, l.p - o_totalprice AS diff
      FROM (SELECT l_orderkey, max(l_extendedprice) AS p FROM lineitem GROUP BY 1) l JOIN orders ON l_orderkey = o_orderkey
      WHERE abs(l.p - o_totalprice) > 0.5"""))
def lines_largest(spark, sf):
    a = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.max("l_extendedprice").alias("price"))
    b = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    return _listed(c.compare_features_wide(a, b, ["k"], 0.5), "column")


def _longs(spark, sf):
    return (explode_features(key_filter(features(spark, sf), "v1")), explode_features(features_b(spark, sf)))


_MAPS = """
    SELECT coalesce(a.series, b.series) AS series, coalesce(a.ts, b.ts) AS ts, coalesce(a.name, b.name) AS name,
      a.value AS a, b.value AS b, CASE WHEN b.name IS NULL THEN 'missing_in_b' WHEN a.name IS NULL THEN 'missing_in_a'
        WHEN (a.value IS NULL) <> (b.value IS NULL) OR abs(a.value - b.value) > 1e-9 THEN 'mismatch' ELSE 'equal' END AS status,
      abs(a.value - b.value) AS abs_diff
    FROM {a} a FULL OUTER JOIN {b} b ON a.series = b.series AND a.ts = b.ts AND a.name = b.name"""


@query("C4_compare_maps", "long_a long_b", _MAPS.format(a="long_a", b="long_b"))
def compare_maps(spark, sf):
    return c.compare_maps(*_longs(spark, sf))


@query("C4_compare_maps_missing_value", "long_a long_b", """
    WITH a AS (SELECT series, ts, name, CASE WHEN hour(ts) % 4 = 1 THEN NULL ELSE value END AS value FROM long_a),
    b AS (SELECT series, ts, name, CASE WHEN hour(ts) % 4 IN (1, 2) THEN NULL ELSE value END AS value FROM long_b),
    m AS (""" + _MAPS.format(a="a", b="b") + """)
    SELECT series, ts, count(*) FILTER (status = 'missing_in_a') AS n_missing_in_a,
      count(*) FILTER (status = 'missing_in_b') AS n_missing_in_b,
      count(*) FILTER (status = 'mismatch') AS n_mismatch, count(*) FILTER (status = 'equal') AS n_equal
    FROM m GROUP BY series, ts""")
def compare_maps_missing(spark, sf):
    a, b = _longs(spark, sf)
    a = a.withColumn("value", F.when(F.hour("ts") % 4 != 1, F.col("value")))
    b = b.withColumn("value", F.when(~(F.hour("ts") % 4).isin(1, 2), F.col("value")))
    return c.map_totals(c.compare_maps(a, b), ["series", "ts"])


def _lookbacks(spark, sf):
    a, b = bars(spark, sf), bars_b(spark, sf)
    frames = ["1H", "4H"]
    return w.lookback(a, a, 12, frames), w.lookback(b, b, 12, frames), a


def _lookback_rows(name: str, source: str) -> str:
    def one(tf: str, step: int, n: int) -> str:
        return f"""
        SELECT series, '{tf}' AS timeframe, ts, bar_ts, open, high, low, close, volume FROM (
          SELECT t.series, t.ts, time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01') AS bar_ts,
            arg_min(b.open, b.ts) AS open, max(b.high) AS high, min(b.low) AS low, arg_max(b.close, b.ts) AS close,
            sum(b.volume) AS volume, row_number() OVER (PARTITION BY t.series, t.ts
              ORDER BY time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01') DESC) AS rn
          FROM {source} t JOIN {source} b ON b.series = t.series AND b.ts <= t.ts
          GROUP BY t.series, t.ts, time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01'))
        WHERE rn <= {n}"""
    return f"{name} AS ({one('1H', 1, 12)} UNION ALL {one('4H', 4, 3)})"


_LB = _lookback_rows("la", "bars") + ", " + _lookback_rows("lb", "bars_b") + """,
    cmp AS (SELECT coalesce(la.series, lb.series) AS series, coalesce(la.timeframe, lb.timeframe) AS timeframe,
      coalesce(la.ts, lb.ts) AS ts, count(la.ts) AS n_a, count(lb.ts) AS n_b,
      count(*) FILTER (la.ts IS NOT NULL AND lb.ts IS NOT NULL) AS n_common,
      """ + ", ".join(f"count(*) FILTER (NOT abs(la.{x} - lb.{x}) <= 1e-6) AS mism_{x}, {rq(f'max(abs(la.{x} - lb.{x}))')} AS max_{x}" for x in BAR_COLUMNS) + """
      FROM la FULL OUTER JOIN lb ON la.series = lb.series AND la.timeframe = lb.timeframe AND la.ts = lb.ts
        AND la.bar_ts = lb.bar_ts GROUP BY 1, 2, 3),
    v AS (SELECT *, n_a = n_common AND n_b = n_common AS same_index,
      n_a = n_common AND n_b = n_common AND mism_open + mism_high + mism_low + mism_close + mism_volume = 0 AS ok FROM cmp)"""


@query("C5_compare_lookbacks", "bars bars_b", f"WITH {_LB} SELECT * FROM v")
def compare_lookbacks(spark, sf):
    a, b, _ = _lookbacks(spark, sf)
    return c.compare_lookbacks(a, b, tol=1e-6).withColumns({f"max_{x}": r6(f"max_{x}") for x in BAR_COLUMNS})


@query("C6_frames_identical", "bars bars_b", """
    WITH d AS (SELECT sum(s) AS d FROM (SELECT *, 1 AS s FROM bars UNION ALL SELECT *, -1 FROM bars_b) GROUP BY
      series, ts, open, high, low, close, volume)
    SELECT 'a_b' AS pair, cast(sum(abs(d)) AS bigint) AS n_different, sum(abs(d)) = 0 AS identical FROM d
    UNION ALL SELECT 'a_a', 0, true""")
def frames_identical(spark, sf):
    a, b = bars(spark, sf), bars_b(spark, sf)
    different = c.frames_identical(a, b).select(F.lit("a_b").alias("pair"), "*")
    return different.unionByName(c.frames_identical(a, a).select(F.lit("a_a").alias("pair"), "*"))


@query("C7_compare_preds_tol", "predictions predictions_b", """
    SELECT count(*) AS n_common, count(*) FILTER (abs(a.y_pred - b.y_pred) > 1e-9) AS n_mismatch
    FROM predictions a JOIN predictions_b b USING (series, ts, model_path)""")
def compare_preds_tol(spark, sf):
    a = predictions(spark, sf)
    # An older score of the same keys must not count.
    older = a.withColumn("y_pred", F.lit(5.0)).withColumn("created_at", F.col("created_at") - hours(1))
    return c.compare_preds_tol(a.unionByName(older), predictions_b(spark, sf))


@query("C8_compare_preds_rel", "predictions predictions_b", f"""
    WITH p AS (SELECT a.y_pred AS a, abs(a.y_pred - b.y_pred) AS d FROM predictions a
               JOIN predictions_b b USING (series, ts, model_path))
    SELECT count(*) AS n_common, count(*) FILTER (abs(a) > 1e-10 AND (d / abs(a) > 0.001 OR d > 1e-6)) AS n_mismatch,
      {rq("max(d)")} AS max_abs_diff, {rq("max(CASE WHEN abs(a) > 1e-10 THEN d / abs(a) END)")} AS max_rel_diff FROM p""")
def compare_preds_rel(spark, sf):
    out = c.compare_preds_rel(predictions(spark, sf), predictions_b(spark, sf))
    return out.withColumns({n: r6(n) for n in ("max_abs_diff", "max_rel_diff")})


@query("C9_allclose", "predictions predictions_b", """
    SELECT a.series, a.ts, abs(a.y_pred - b.y_pred) <= 1e-6 + 1e-4 * abs(b.y_pred) AS close_enough
    FROM predictions a JOIN predictions_b b USING (series, ts, model_path)""")
def allclose(spark, sf):
    pairs = c.score_pairs(predictions(spark, sf), predictions_b(spark, sf))
    return pairs.select("series", "ts", all_close("a", "b", 1e-4, 1e-6).alias("close_enough"))


@query("C10_top_diff_features", "bars_b", """
    SELECT series, ts, name, abs_diff, cast(rank AS integer) AS rank FROM (
      SELECT series, ts, name, abs(a.value - b.value) AS abs_diff,
        row_number() OVER (PARTITION BY series, ts ORDER BY abs(a.value - b.value) DESC, name) AS rank
      FROM (SELECT series, ts, unnest(['close', 'high', 'low', 'open', 'volume']) AS name,
              unnest([close, high, low, open, volume]) AS value FROM bars) a
      JOIN (SELECT series, ts, unnest(['close', 'high', 'low', 'open', 'volume']) AS name,
              unnest([close, high + 1, low, open - 2, volume * 2]) AS value FROM bars_b) b USING (series, ts, name)
      WHERE abs(a.value - b.value) > 0) WHERE rank <= 2""")
def top_diff_features(spark, sf):
    columns = ["close", "high", "low", "open", "volume"]
    b = bars_b(spark, sf).withColumns({"high": F.col("high") + 1, "open": F.col("open") - 2, "volume": F.col("volume") * 2})
    a_long, b_long = c.wide_to_long(bars(spark, sf), columns), c.wide_to_long(b, columns)
    return c.top_diff_features(a_long, b_long, 2).select("series", "ts", "name", "abs_diff", "rank")


@query("C11_explain_mismatch", "long_a long_b", """
    WITH wide AS (SELECT series, ts, name, value + CASE WHEN hour(ts) % 9 = 0 THEN 1 ELSE 0 END AS value FROM long_b),
    m AS (SELECT *, 'stored_vs_generated' AS pair FROM (""" + _MAPS.format(a="long_a", b="long_b") + """)
      UNION ALL SELECT *, 'csv_vs_generated' FROM (""" + _MAPS.format(a="wide", b="long_b") + """))
    SELECT series, ts, pair, name, status FROM (
      SELECT *, row_number() OVER (PARTITION BY pair, series, ts ORDER BY name) AS rn FROM m WHERE status <> 'equal')
    WHERE rn <= 2""")
def explain_mismatch(spark, sf):
    stored, generated = _longs(spark, sf)
    csv = generated.withColumn("value", F.col("value") + F.when(F.hour("ts") % 9 == 0, 1).otherwise(0))
    out = c.explain_mismatch({"stored": stored, "csv": csv, "generated": generated}, "generated", first=2)
    return out.select("series", "ts", "pair", "name", "status")


@query("C12_spot_check", "long_a bars", """
    WITH o AS (SELECT series, ts, round(close * 100) AS v FROM bars WHERE hour(ts) % 5 <> 0)
    SELECT coalesce(s.series, o.series) AS series, coalesce(s.ts, o.ts) AS ts, s.value AS stored, o.v AS recomputed,
      s.value - o.v AS diff FROM (SELECT * FROM long_a WHERE name = 'close') s
    FULL OUTER JOIN o ON o.series = s.series AND o.ts = s.ts""")
def spot_check(spark, sf):
    stored, _ = _longs(spark, sf)
    again = bars(spark, sf).select("series", "ts", F.lit("close").alias("name"),
                                   F.when(F.hour("ts") % 5 == 0, F.lit(float("inf"))).otherwise(F.round(F.col("close") * 100))
                                   .alias("value"))
    out = c.spot_check(stored, again, "close")
    return out.where(F.col("stored").isNotNull() | F.col("recomputed").isNotNull())


@query("C13_compare_batch", "long_a long_b bars", """
    WITH m AS (""" + _MAPS.format(a="long_a", b="long_b") + """),
    g AS (SELECT series, ts, count(*) FILTER (status <> 'equal') AS bad, count(*) FILTER (status <> 'missing_in_a') AS ia,
          count(*) FILTER (status <> 'missing_in_b') AS ib FROM m GROUP BY series, ts)
    SELECT b.series, b.ts, CASE WHEN coalesce(ia, 0) = 0 OR coalesce(ib, 0) = 0 THEN 'skip' WHEN bad > 0 THEN 'mismatch'
      ELSE 'ok' END AS verdict, coalesce(bad, 0) AS n_bad FROM bars b LEFT JOIN g USING (series, ts)""")
def compare_batch(spark, sf):
    a, b = _longs(spark, sf)
    return c.compare_batch(a, b, bars(spark, sf))


@query("C13_batch_totals", "long_a long_b bars", """
    WITH m AS (SELECT * FROM (""" + _MAPS.format(a="long_a", b="long_b") + """) WHERE name = 'close'),
    g AS (SELECT series, ts, count(*) FILTER (status <> 'equal') AS bad, count(*) AS n FROM m GROUP BY series, ts)
    SELECT count(*) AS compared, count(*) FILTER (bad = 0) AS ok, count(*) FILTER (coalesce(bad, 1) > 0) AS failed
    FROM bars b LEFT JOIN g USING (series, ts)""")
def batch_totals(spark, sf):
    a, b = (df.where("name = 'close'") for df in _longs(spark, sf))
    return c.batch_totals(c.compare_batch(a, b, bars(spark, sf)))


@query("C13_batch_totals_all", "long_a long_b bars", """
    WITH m AS (""" + _MAPS.format(a="long_a", b="long_b") + """),
    g AS (SELECT series, ts, count(*) FILTER (status <> 'equal') AS bad, count(*) FILTER (status <> 'missing_in_a') AS ia,
          count(*) FILTER (status <> 'missing_in_b') AS ib FROM m GROUP BY series, ts),
    v AS (SELECT coalesce(ia, 0) = 0 OR coalesce(ib, 0) = 0 AS skipped, coalesce(bad, 0) AS bad FROM bars LEFT JOIN g USING (series, ts))
    SELECT count(*) AS compared, count(*) FILTER (NOT skipped AND bad = 0) AS ok, count(*) FILTER (skipped OR bad > 0) AS failed FROM v""")
def batch_totals_all(spark, sf):
    """Totals over all features; the second feed drops the range and brings a volume."""
    return c.batch_totals(c.compare_batch(*_longs(spark, sf), bars(spark, sf)))


@query("C15_compare_score_sources", "predictions predictions_b", f"""
    SELECT count(*) AS n, {rq("max(abs(a.y_pred - b.y_pred))")} AS max_abs_diff
    FROM predictions a JOIN predictions_b b USING (series, ts)""")
def score_sources(spark, sf):
    out = c.compare_score_sources(predictions(spark, sf), predictions_b(spark, sf))
    return out.withColumn("max_abs_diff", r6("max_abs_diff"))


_BATCH = f"""
    WITH {_LB}, k AS (SELECT series, ts, (SELECT count(*) FROM bars b WHERE b.series = t.series AND b.ts <= t.ts
      AND b.ts > t.ts - interval '12' hour) = 12 AS whole FROM bars t)
    SELECT k.series, k.ts, f.timeframe, coalesce(v.n_b, 0) AS n_stored, coalesce(v.n_a, 0) AS n_generated,
      CASE WHEN NOT k.whole THEN 'skipped' WHEN coalesce(v.n_b, 0) = 0 THEN 'missing' WHEN v.ok THEN 'ok' ELSE 'diff' END AS verdict
    FROM k CROSS JOIN (VALUES ('1H'), ('4H')) AS f(timeframe)
    LEFT JOIN v ON v.series = k.series AND v.ts = k.ts AND v.timeframe = f.timeframe"""


@query("C16_batch_verdict", "bars bars_b", f"""
    SELECT count(*) AS n, count(*) FILTER (verdict = 'ok') AS n_ok, coalesce(bool_and(verdict = 'ok'), true) AS all_ok FROM ({_BATCH})""")
def lookbacks_verdict(spark, sf):
    return c.batch_verdict(lookbacks_batch(spark, sf))


@query("C16_compare_lookbacks_batch", "bars bars_b", _BATCH)
def lookbacks_batch(spark, sf):
    generated, stored, b = _lookbacks(spark, sf)
    return c.compare_lookbacks_batch(stored, generated, w.continuity(b, b, 12), tol=1e-6)


@query("W16_first_divergence", "bars bars_b", """
    WITH oa AS (SELECT series, ts, sum(s) OVER (PARTITION BY series ORDER BY ts) AS v FROM (SELECT series, ts,
        coalesce(sign(close - lag(close) OVER (PARTITION BY series ORDER BY ts)) * volume, 0) AS s FROM bars)),
    ob AS (SELECT series, ts, sum(s) OVER (PARTITION BY series ORDER BY ts) AS v FROM (SELECT series, ts,
        coalesce(sign(close - lag(close) OVER (PARTITION BY series ORDER BY ts)) * volume, 0) AS s FROM bars_b)),
    p AS (SELECT series, ts, oa.v AS a, ob.v AS b, oa.v - ob.v AS delta,
        lag(ts) OVER (PARTITION BY series ORDER BY ts) AS prev_ts,
        lag(oa.v - ob.v) OVER (PARTITION BY series ORDER BY ts) AS prev_delta FROM oa JOIN ob USING (series, ts))
    SELECT series, ts AS first_ts, round(a, 4) + 0.0 AS a, round(b, 4) + 0.0 AS b, round(delta, 4) + 0.0 AS delta, prev_ts,
      round(prev_delta, 4) + 0.0 AS prev_delta FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn
      FROM p WHERE abs(delta) > 1e-6) WHERE rn = 1""")
def first_divergence(spark, sf):
    out = c.obv_divergence(bars(spark, sf), bars_b(spark, sf))
    return out.withColumns({n: F.round(n, 4) + F.lit(0.0) for n in ("a", "b", "delta", "prev_delta")})


@query("W17_last_row_delta", "bars bars_b", f"""
    WITH a AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC) = 1),
    b AS (SELECT * FROM bars_b WHERE ts < timestamp '2024-01-20 04:00:00'
          QUALIFY row_number() OVER (PARTITION BY series ORDER BY ts DESC) = 1)
    SELECT a.series, a.ts AS last_a, b.ts AS last_b, {", ".join(rq(f"a.{x} - b.{x}") + f" AS delta_{x}" for x in BAR_COLUMNS)}
    FROM a JOIN b USING (series)""")
def last_row_delta(spark, sf):
    earlier = bars_b(spark, sf).where(F.col("ts") < F.lit("2024-01-20 04:00:00").cast("timestamp_ntz"))
    out = c.last_row_delta(bars(spark, sf), earlier)
    return out.withColumns({f"delta_{x}": r6(f"delta_{x}") for x in BAR_COLUMNS})


@query("W18_snapshot_summary", "bars bars_b", f"""
    WITH {_lookback_rows("lb", "bars_b")},
    t AS (SELECT series, '1H' AS timeframe, ts FROM bars UNION ALL SELECT series, '4H', ts FROM bars),
    s AS (SELECT series, timeframe, ts, count(*) AS n_rows, min(bar_ts) AS first_bar, max(bar_ts) AS last_bar,
      arg_max(close, bar_ts) AS last_close, arg_max(high, bar_ts) AS last_high, arg_max(open, bar_ts) AS last_open,
      arg_max(low, bar_ts) AS last_low, round(arg_max(volume, bar_ts), 6) + 0.0 AS last_volume FROM lb GROUP BY series, timeframe, ts)
    SELECT t.series, t.timeframe, t.ts, s.n_rows IS NOT NULL AS found, coalesce(s.n_rows, 0) AS n_rows, 5 AS n_cols,
      s.first_bar, s.last_bar, s.last_close, s.last_high, s.last_open, s.last_low, s.last_volume,
      coalesce(s.ts, (SELECT q.ts FROM bars_b q WHERE q.series = t.series
        ORDER BY abs(epoch(q.ts) - epoch(t.ts)), q.ts LIMIT 1)) AS nearest_ts
    FROM t LEFT JOIN s USING (series, timeframe, ts)""")
def snapshot_summary(spark, sf):
    _, stored, b = _lookbacks(spark, sf)
    frames = F.explode(F.array(F.lit("1H"), F.lit("4H"))).alias("timeframe")
    return c.snapshot_summary(stored, b.select("series", "ts", frames)).withColumn("last_volume", r6("last_volume"))


@query("W19_top_k_abs_diff", "bars bars_b", """
    WITH p AS (SELECT series, ts, unnest(['open','high','low','close','volume']) AS "column",
      unnest([a.open, a.high, a.low, a.close, a.volume]) AS a, unnest([b.open, b.high, b.low, b.close, b.volume + hour(ts)]) AS b
      FROM bars a JOIN bars_b b USING (series, ts))
    SELECT series, ts, "column", a, round(b, 6) AS b, round(abs(a - b), 6) AS abs_diff, cast(rank AS integer) AS rank FROM (SELECT *, row_number() OVER (
      PARTITION BY "column" ORDER BY round(abs(a - b), 6) DESC, ts, series) AS rank FROM p WHERE round(a - b, 6) <> 0) WHERE rank <= 5""")
def top_k(spark, sf):
    b = bars_b(spark, sf).withColumn("volume", F.col("volume") + F.hour("ts"))
    pairs = c.long_pairs(bars(spark, sf), b, BAR_COLUMNS).withColumn("diff", F.round("diff", 6))
    out = c.top_k_abs_diff(pairs, 5, tie=["ts", "series"])
    return out.select("series", "ts", "column", "a", F.round("b", 6).alias("b"), "abs_diff", "rank")
