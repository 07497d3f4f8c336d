"""Scoring files: one feature file, or two merged ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.features import latest_features
from barline.operators.joins import merge_wide
from barline.operators.scoring import (
    TreeModel, align_lenient, load_models, score_maps, score_wide, with_feature_map,
)
from barline.operators.targets import Stamp
from barline.sources.files import latest_file
from barline.sources.models import latest_model, read_model_trees
from barline.sources.sinks import prediction_columns, write_predictions_csv
from barline.sources.tables import in_range, read_any, resolve_time


def load_model_file(spark: SparkSession, root: str, model_path: str | None = None) -> TreeModel:
    """The explicit or newest model under ``root``."""
    path = latest_model(spark, root, model_path)
    return load_models(read_model_trees(spark, path))[0]


def score_frame(df: DataFrame, model: TreeModel, *, id_column: str | None = None, merge_input: bool = False,
                num_iteration: int | None = None, method: str = "auto") -> DataFrame:
    """Scores of wide rows: missing features are filled with NULL, text is
    coerced, other columns are carried only when asked for."""
    inputs = [F.col(f"`{c}`").alias(f"_in_{c}") for c in df.columns]
    staged = df.select("*", *inputs)
    carried = [f"_in_{c}" for c in df.columns]
    scored = score_wide(align_lenient(staged, model.features, keep=carried), model, num_iteration=num_iteration,
                        method=method)
    back = scored.select("y_pred", *[F.col(f"`_in_{c}`").alias(c) for c in df.columns if c != "y_pred"])
    return prediction_columns(back, id_column, merge_input)


def score_file(spark: SparkSession, path: str, model: TreeModel, out: str | None = None, *,
               id_column: str | None = None, merge_input: bool = False, num_iteration: int | None = None) -> DataFrame:
    """Score a feature file, and write the scores when ``out`` is given."""
    result = score_frame(read_any(spark, path), model, id_column=id_column, merge_input=merge_input,
                         num_iteration=num_iteration)
    if out is not None:
        write_predictions_csv(result, out, id_column, merge_input)
    return result


class NoOverlap(ValueError):
    """Two feature sources have no time in common."""


def merge_features(current: DataFrame, normalized: DataFrame, start: Stamp, end: Stamp | None = None,
                   prefer: str = "cur", on: tuple[str, ...] = ("timestamp",)) -> DataFrame:
    """Both sources from ``start`` on, joined on their common times."""
    left, right = (in_range(df, "timestamp", start, end) for df in (current, normalized))
    return merge_wide(left, right, on, prefer)


def merge_and_score(current: DataFrame, normalized: DataFrame, model: TreeModel, start: Stamp,
                    end: Stamp | None = None, prefer: str = "cur", on: tuple[str, ...] = ("timestamp",), *,
                    check: bool = True) -> DataFrame:
    """Scores of two merged feature sources as ``on, y_pred``.

    ``check`` looks for one common row first and raises :class:`NoOverlap`.
    """
    merged = merge_features(current, normalized, start, end, prefer, on)
    if check and merged.limit(1).count() == 0:
        raise NoOverlap("no common times from the start on")
    return score_wide(align_lenient(merged, model.features, keep=on), model).select(*on, "y_pred")


def merge_and_score_files(spark: SparkSession, folder: str, current_pattern: str, normalized_pattern: str,
                          model: TreeModel, start: Stamp, end: Stamp | None = None, prefer: str = "cur") -> DataFrame:
    """As :func:`merge_and_score`, from the newest file of each pattern."""
    frames = [resolve_time(read_any(spark, latest_file(spark, folder, p))) for p in (current_pattern, normalized_pattern)]
    return merge_and_score(*frames, model, start, end, prefer)


def score_latest_rows(features: DataFrame, model: TreeModel, feature_key: str | None = None) -> DataFrame:
    """Score of every series' newest stored features, missing ones filled."""
    keyed = features.where(F.col("feature_key") == feature_key) if feature_key else features
    newest_ts = keyed.groupBy("series").agg(F.max("ts").alias("ts"))
    rows = latest_features(keyed.join(newest_ts, ["series", "ts"], "left_semi"))
    return score_maps(with_feature_map(rows), model).select("series", "ts", "y_pred")
