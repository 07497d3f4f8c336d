"""Scores for a stream of feature rows, one per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barline.operators.features import latest_features
from barline.operators.scoring import TreeModel, score_json
from barline.operators.store import Store


def stream_scores(features: DataFrame, models: Sequence[TreeModel], store: Store, checkpoint: str, *,
                  dataset: str | None = None, available_now: bool = True, interval: str = "1 minute"
                  ) -> StreamingQuery:
    """Score new feature rows and add the scores the store does not have.

    A batch that is run again after a failure finds its rows stored and adds
    nothing, so every key is stored once. Within a batch the newest features
    of a bar count.
    """
    store.ensure()

    def add(batch: DataFrame, _: int) -> None:
        newest = latest_features(batch).select("series", "ts", "feature_key", "features")
        scored = score_json(newest, models).select(
            "series", "ts", "model_path", "y_pred", "feature_key", F.lit(dataset).cast("string").alias("dataset"))
        store.append_missing(scored)

    writer = features.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
