"""Closed bars of a file stream, run step by step."""

from __future__ import annotations

from datetime import datetime

from barline.streaming.bars import stream_bars, write_bars

SCHEMA = "series string, ts timestamp_ntz, value double"


def test_late_ticks_are_dropped_and_a_restart_goes_on(spark, tmp_path):
    source, out, log = (str(tmp_path / x) for x in ("ticks", "bars", "log"))

    def play(*ticks):
        made = [("s", datetime(2024, 1, 1, h, m), v) for h, m, v in ticks]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        query = write_bars(stream_bars(stream), out, log)
        query.awaitTermination()
        rows = spark.read.schema("series string, ts timestamp_ntz, open double, high double, low double, close double, volume double").parquet(out)
        return {r.ts.hour: (r.open, r.high, r.low, r.close, r.volume) for r in rows.collect()}

    first = {0: (1.0, 3.0, 1.0, 3.0, 4.0)}
    assert play((0, 5, 1.0), (0, 50, 3.0), (1, 10, 5.0), (1, 12, 4.0)) == first  # the bar of one o'clock is open
    # 0:55 is late: its bar is out. 1:01 is older than the watermark's 1:02 but its bar is still open.
    assert play((0, 55, 100.0), (1, 1, 7.0), (1, 40, 6.0)) == first
    second = first | {1: (7.0, 7.0, 4.0, 6.0, 22.0)}
    assert play((3, 0, 2.0)) == second
    assert play((1, 59, 50.0), (3, 30, 9.0), (5, 0, 1.0)) == second | {3: (2.0, 9.0, 2.0, 9.0, 11.0)}
