"""Queries: streaming bars and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import store as st
from barline.session import scratch_path
from barline.streaming.bars import stream_bars, write_bars
from barline.streaming.scores import stream_scores
from suite.base import features, models, predictions, query, table
from suite.scores import _M1, _M2, _m


def _run(query_):
    query_.awaitTermination()
    if query_.exception() is not None:
        raise query_.exception()


@query("R1_stream_bars", "bars", """
    SELECT series, ts, open, high, low, close, volume FROM bars
    WHERE ts + interval '1' hour <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - interval '10' minute""")
def bars_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    ticks = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
             .select("event_type", "ts", "event_id", "value"))
    out, checkpoint = scratch_path(spark, "stream-bars"), scratch_path(spark, "stream-bars-log")
    _run(write_bars(stream_bars(ticks, series="event_type", order=("ts", "event_id")), out, checkpoint))
    return spark.read.parquet(out).withColumn("volume", F.round("volume", 6))


@query("R1_late_ticks", "bars", """
    SELECT series, ts, open, high, low, close, volume FROM bars
    WHERE ts + interval '1' hour <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - interval '10' minute""")
def late_ticks(spark, sf):
    """The ticks in two runs of one stream. The second run, after a restart, brings the
    newer ticks, and late ones for bars that the first run has closed: they are dropped."""
    source, out, log = (scratch_path(spark, f"stream-{x}") for x in ("ticks", "late", "late-log"))
    events = table(spark, sf, "events").select("event_type", "ts", "event_id", "value")
    first = F.col("ts") < F.lit("2024-01-12 06:30:00").cast(events.schema["ts"].dataType)
    late = events.where(first & (F.col("ts") < F.lit("2024-01-12").cast(events.schema["ts"].dataType))).withColumn("value", F.lit(1e9))
    for step in (events.where(first), events.where(~first).unionByName(late)):
        step.write.mode("append").parquet(source)
        ticks = spark.readStream.schema(events.schema).parquet(source)
        _run(write_bars(stream_bars(ticks, series="event_type", order=("ts", "event_id")), out, log))
    return spark.read.parquet(out).withColumn("volume", F.round("volume", 6))


@query("R2_stream_score", "latest predictions", f"""
    SELECT series, ts, model_path, y_pred, feature_key FROM predictions
    UNION ALL
    SELECT f.series, f.ts, m.model_path, CASE m.model_path WHEN 'm1' THEN {_m(_M1, 'f')} ELSE {_m(_M2, 'f')} END, f.feature_key
    FROM latest f CROSS JOIN (VALUES ('m1'), ('m2')) AS m(model_path)
    WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.series = f.series AND p.ts = f.ts AND p.model_path = m.model_path)""")
def score_stream(spark, sf):
    """Scores of a stream of feature rows, added to stored ones; the stream is
    then played a second time from its start and must add nothing."""
    source = scratch_path(spark, "stream-features")
    features(spark, sf).write.parquet(source)
    store = st.score_store(spark, scratch_path(spark, "stream-scores")).ensure()
    store.append_unique(predictions(spark, sf))
    rows = spark.readStream.schema(st.FEATURE_SCHEMA).parquet(source)
    for _ in range(2):
        _run(stream_scores(rows, models(spark, "m1", "m2"), store, scratch_path(spark, "stream-log")))
    return store.read().select("series", "ts", "model_path", "y_pred", "feature_key")
