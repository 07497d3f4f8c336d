"""Queries: time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.columns import hours, ts_key
from barline.operators import joins as j
from barline.operators import series as w
from barline.operators.indicators import IndicatorSpec, indicators, lag_features, recompute_features
from suite.base import bars, bars_b, predictions, query, r6, rq


@query("W2_forward_return", "bars", f"""
    SELECT series, ts, {rq("ln(c24 / close)")} AS y_true FROM (
      SELECT series, ts, close, lead(close, 24) OVER (PARTITION BY series ORDER BY ts) AS c24 FROM bars)
    WHERE c24 IS NOT NULL AND c24 > 0 AND close > 0""")
def forward_return(spark, sf):
    return w.forward_return(bars(spark, sf), 24).select("series", "ts", r6("y_true").alias("y_true"))


@query("W2_forward_return_short", "bars", f"""
    SELECT series, ts, {rq("last_close / close - 1")} AS y_true FROM (
      SELECT series, ts, close, count(*) OVER f AS n, last_value(close) OVER f AS last_close
      FROM bars WINDOW f AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND 48 FOLLOWING))
    WHERE n >= 5 AND close <> 0""")
def forward_return_short(spark, sf):
    out = w.forward_return(bars(spark, sf), 48, log=False, min_forward=5, chunk_hours=100, block_rows=200)
    return out.select("series", "ts", r6("y_true").alias("y_true"))


@query("W3_target_scan_range", "bars", f"""
    WITH scan AS (SELECT * FROM bars WHERE ts >= timestamp '2024-01-06 00:00:00'
                  AND ts <= timestamp '2024-01-16 00:00:00' + interval '24' hour),
    f AS (SELECT series, ts, close, lead(close, 24) OVER (PARTITION BY series ORDER BY ts) AS c FROM scan)
    SELECT series, ts AS "timestamp", 'y_logret_24h' AS target_name, {rq("ln(c / close)")} AS y_true,
      24 AS horizon_bars, '24h' AS target_label, 'v1' AS feature_key
    FROM f WHERE ts <= timestamp '2024-01-16 00:00:00' AND c > 0 AND close > 0""")
def target_scan_range(spark, sf):
    out = w.generate_targets(bars(spark, sf), start="2024-01-06", end="2024-01-16", horizon=24, feature_key="v1")
    return out.withColumn("y_true", r6("y_true"))


_OBV = """SELECT series, ts, round(sum(s) OVER (PARTITION BY series ORDER BY ts), 4) + 0.0 AS obv FROM (
      SELECT series, ts, coalesce(sign(close - lag(close) OVER (PARTITION BY series ORDER BY ts)) * volume, 0) AS s
      FROM bars)"""


@query("W4_obv", "bars", _OBV)
def obv(spark, sf):
    return w.obv(bars(spark, sf), chunk_hours=96).withColumn("obv", F.round("obv", 4) + F.lit(0.0))


def _lookback_sql(tf: str, step: int, n: int) -> str:
    return f"""
    SELECT t.series, '{tf}' AS timeframe, t.ts, count(*) AS n, min(q.bar_ts) AS first_bar, max(q.bar_ts) AS last_bar,
      {rq("sum(q.volume)")} AS volume, {rq("sum(q.close)")} AS sum_close, max(q.high) AS high
    FROM t JOIN (
      SELECT t.series, t.ts, time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01') AS bar_ts,
        max(b.high) AS high, arg_max(b.close, b.ts) AS close, sum(b.volume) AS volume,
        row_number() OVER (PARTITION BY t.series, t.ts
          ORDER BY time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01') DESC) AS rn
      FROM t JOIN bars b ON b.series = t.series AND b.ts <= t.ts
      GROUP BY t.series, t.ts, time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01')) q
    ON q.series = t.series AND q.ts = t.ts WHERE q.rn <= {n} GROUP BY t.series, t.ts"""


@query("W11_lookback", "bars", """
    WITH t AS (SELECT series, ts FROM bars) """ + " UNION ALL ".join(
    _lookback_sql(tf, h, 72 // h) for tf, h in (("1H", 1), ("4H", 4), ("12H", 12), ("1D", 24))))
def lookback(spark, sf):
    b = bars(spark, sf)
    rows = w.lookback(b, b, 72)
    return rows.groupBy("series", "timeframe", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.min("bar_ts").alias("first_bar"), F.max("bar_ts").alias("last_bar"),
        r6(F.sum("volume")).alias("volume"), r6(F.sum("close")).alias("sum_close"), F.max("high").alias("high"))


@query("W12_trim_lookback", "bars", """
    WITH t AS (SELECT series, ts FROM bars), x AS (
      SELECT t.series, t.ts, count(*) AS n, max(b.ts) AS last_bar FROM t JOIN bars b
      ON b.series = t.series AND b.ts <= t.ts AND b.ts > t.ts - interval '24' hour GROUP BY t.series, t.ts)
    SELECT series, ts, '1H' AS timeframe, n, last_bar, cast(24 AS bigint) AS expected, n = 24 AND last_bar = ts AS "exact"
    FROM x""")
def trim_lookback(spark, sf):
    b = bars(spark, sf)
    wide = w.lookback(b, b, 30, ["1H"])
    # The buffered window is 30 rows, so a gap may leave it reaching back too far.
    return w.validate_exact(w.trim_lookback(wide, 24), 24)


_SPAN = """(SELECT series, ts, (SELECT count(*) FROM bars b WHERE b.series = t.series AND b.ts <= t.ts
            AND b.ts > t.ts - interval '36' hour) AS present_hours FROM bars t)"""


@query("W13_hourly_continuity", "bars",
       f"SELECT series, ts, present_hours, present_hours = 36 AS continuous FROM {_SPAN}")
def hourly_continuity(spark, sf):
    b = bars(spark, sf)
    return w.continuity(b, b, 36)


@query("W13_missing_hours", "bars", """
    WITH x AS (SELECT series, unnest(generate_series(min(ts), max(ts), interval '1' hour)) AS ts
               FROM bars GROUP BY series)
    SELECT series, ts FROM x WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.series = x.series AND b.ts = x.ts)""")
def missing_hours(spark, sf):
    return w.missing_hours(bars(spark, sf))


def _with_partial(spark, sf):
    """Bars plus, per series, one half-hour row after the last."""
    b = bars(spark, sf).select("series", "ts", "close")
    late = b.groupBy("series").agg((F.max("ts") + F.expr("interval 30 minutes")).alias("ts"),
                                   F.max("close").alias("close"))
    return b.unionByName(late)


@query("W14_latest_complete_hour", "bars", "SELECT series, ts, close FROM bars")
def trim_partial(spark, sf):
    return w.trim_partial(_with_partial(spark, sf))


@query("W15_min_history", "bars",
       "SELECT series, count(*) AS n, max(ts) AS latest_ts, count(*) >= 675 AS enough FROM bars GROUP BY series")
def min_history(spark, sf):
    return w.history(_with_partial(spark, sf), 675)


_EMA = """list_reduce(list(close) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    lambda acc, x: acc + (2.0 / ({n} + 1)) * (x - acc))"""


@query("W20_indicators", "bars", f"""
    WITH d AS (SELECT *, close - lag(close) OVER (PARTITION BY series ORDER BY ts) AS st FROM bars),
    a AS (SELECT series, ts,
        avg(close) OVER w20 AS sma, count(*) OVER w20 AS n20, avg(volume) OVER w20 AS vma,
        sum(greatest(st, 0)) OVER w14 AS g, sum(greatest(-st, 0)) OVER w14 AS l, count(st) OVER w14 AS n14,
        {_EMA.format(n=12)} AS fast, {_EMA.format(n=26)} AS slow
      FROM d WINDOW w20 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
                    w14 AS (PARTITION BY series ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
    SELECT series, ts, {rq("CASE WHEN n20 = 20 THEN sma END")} AS close_sma_20_1H,
      {rq("CASE WHEN n20 = 20 THEN vma END")} AS volume_ma_20_1H,
      {rq("CASE WHEN n14 = 14 AND g + l > 0 THEN 100 * g / (g + l) END")} AS close_rsi_14_1H,
      {rq("fast - slow")} AS close_macd_1H FROM a""")
def indicator_rows(spark, sf):
    out = indicators(bars(spark, sf), "1H")
    return out.withColumns({c: r6(c) for c in out.columns if c not in ("series", "ts")})


@query("W21_lag_features", "bars", "SELECT series, ts, close AS close_1H, " + ", ".join(
    f"lag(close, {k}) OVER w AS close_lag_{k}_1H" for k in range(1, 15))
    + " FROM bars WINDOW w AS (PARTITION BY series ORDER BY ts)")
def lags(spark, sf):
    return lag_features(bars(spark, sf), ["close"], 14, "1H")


@query("W22_marker_levels", "bars predictions", f"""
    SELECT p.series, p.ts, {rq('''CASE WHEN c.close > o.open AND o.open > 0 THEN t.high * 1.002
      WHEN o.open > 0 AND c.close > 0 THEN t.low * 0.998 END''')} AS marker
    FROM predictions p JOIN bars t ON t.series = p.series AND t.ts = p.ts
    JOIN bars o ON o.series = p.series AND o.ts = p.ts + interval '1' hour
    JOIN bars c ON c.series = p.series AND c.ts = p.ts + interval '24' hour WHERE p.y_pred > 0""")
def marker_levels(spark, sf):
    outcomes = j.shifted_outcome(predictions(spark, sf).where("y_pred > 0"), bars(spark, sf))
    return w.marker_levels(outcomes).select("series", "ts", r6("marker").alias("marker"))


def _recomputed_sql(step: int, rows: int) -> str:
    """Indicators of the last ``rows`` bars as of each target, one tf."""
    tf = {1: "1H", 4: "4H"}[step]
    return f"""
    q{tf} AS (SELECT series, ts, list(close ORDER BY bar_ts) AS cl, list(volume ORDER BY bar_ts) AS vo FROM (
        SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY bar_ts DESC) AS rn FROM (
          SELECT t.series, t.ts, time_bucket(interval '{step}' hour, b.ts, timestamp '1970-01-01') AS bar_ts,
            arg_max(b.close, b.ts) AS close, sum(b.volume) AS volume
          FROM t JOIN bars b ON b.series = t.series AND b.ts <= t.ts GROUP BY ALL)) WHERE rn <= {rows}
      GROUP BY series, ts),
    s{tf} AS (SELECT series, ts, cl, vo, len(cl) AS n, list_transform(range(greatest(2, len(cl) - 3), len(cl) + 1),
        lambda i: cl[i] - cl[i - 1]) AS st FROM q{tf}),
    f{tf} AS (SELECT series, ts,
      {rq("CASE WHEN n >= 5 THEN list_avg(cl[-5:]) END")} AS close_sma_5_{tf},
      {rq("CASE WHEN n >= 5 THEN list_avg(vo[-5:]) END")} AS volume_ma_5_{tf},
      {rq('''CASE WHEN n >= 5 AND list_sum(list_transform(st, lambda d: abs(d))) > 0 THEN
        100 * list_sum(list_transform(st, lambda d: greatest(d, 0))) / list_sum(list_transform(st, lambda d: abs(d))) END''')}
        AS close_rsi_4_{tf},
      {rq(f'''list_reduce(cl, lambda acc, x: acc + (2.0 / 4) * (x - acc))
        - list_reduce(cl, lambda acc, x: acc + (2.0 / 7) * (x - acc))''')} AS close_macd_{tf} FROM s{tf})"""


@query("W23_recompute_features", "bars", f"""
    WITH t AS (SELECT series, ts FROM bars b0 WHERE (SELECT count(*) FROM bars b WHERE b.series = b0.series
      AND b.ts <= b0.ts AND b.ts > b0.ts - interval '30' hour) = 30),
    {_recomputed_sql(1, 24)}, {_recomputed_sql(4, 6)}
    SELECT * FROM f1H JOIN f4H USING (series, ts)""")
def recompute(spark, sf):
    spec = IndicatorSpec(sma=(5,), rsi=4, macd=(3, 6), volume_ma=5)
    b = bars(spark, sf)
    out = recompute_features(b, b, 24, 6, ["1H", "4H"], spec)
    return out.withColumns({c: r6(c) for c in out.columns if c not in ("series", "ts")})


@query("W24_lookback_at", "bars bars_b", """
    SELECT t.series, '1H' AS timeframe, strftime(t.ts, '%Y%m%d_%H%M%S') AS ts_key, b.ts AS bar_ts, b.close
    FROM bars t JOIN (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS p FROM bars_b) e
      ON e.series = t.series AND e.ts = t.ts
    JOIN (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS p FROM bars_b) b
      ON b.series = e.series AND b.p <= e.p AND b.p > e.p - 6 WHERE hour(t.ts) % 6 = 4 OR hour(t.ts) % 6 = 5""")
def lookback_at(spark, sf):
    b = bars_b(spark, sf)
    store = w.lookback(b, b, 6, ["1H"])
    wanted = bars(spark, sf).where(F.hour("ts") % 6 >= 4).select(
        "series", F.lit("1H").alias("timeframe"), ts_key("ts").alias("ts_key"))
    return w.lookback_at(store, wanted).select("series", "timeframe", "ts_key", "bar_ts", "close")


@query("W24_absent_lookbacks", "bars bars_b", """
    SELECT series, '1H' AS timeframe, strftime(ts + interval '2' hour, '%Y%m%d_%H%M%S') AS ts_key FROM bars t
    WHERE NOT EXISTS (SELECT 1 FROM bars_b b WHERE b.series = t.series AND b.ts = t.ts + interval '2' hour)""")
def absent_lookbacks(spark, sf):
    b = bars_b(spark, sf)
    store = w.lookback(b, b, 2, ["1H"])
    wanted = bars(spark, sf).select("series", F.lit("1H").alias("timeframe"),
                                    ts_key(F.col("ts") + hours(2)).alias("ts_key"))
    return w.absent_lookbacks(store, wanted)
