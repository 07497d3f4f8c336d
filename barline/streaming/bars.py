"""Bars from a stream of ticks, emitted once they are closed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_bars(ticks: DataFrame, *, series: str = "series", ts: str = "ts", value: str = "value",
                order: Sequence[str] = ("ts",), timeframe_hours: int = 1, delay: str = "10 minutes") -> DataFrame:
    """A streaming frame of closed bars.

    A bar is closed when the watermark (newest time seen minus ``delay``) has
    passed its end; ticks later than that are dropped. State holds the open
    bars only.
    """
    seen = (ticks.withColumn("_event", F.col(ts).cast("timestamp")).withWatermark("_event", delay))
    stamp = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    made = (
        seen.groupBy(F.col(series).alias("series"), F.window("_event", f"{timeframe_hours} hours").alias("_w"))
        .agg(F.min_by(value, stamp).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
             F.max_by(value, stamp).alias("close"), F.sum(value).alias("volume"))
    )
    return made.select("series", F.col("_w.start").cast("timestamp_ntz").alias("ts"),
                       "open", "high", "low", "close", "volume")


def write_bars(bars: DataFrame, path: str, checkpoint: str, *, available_now: bool = True,
               interval: str = "1 minute") -> StreamingQuery:
    """Append closed bars to parquet. The file sink's log makes each batch
    visible once."""
    writer = bars.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start(path)
