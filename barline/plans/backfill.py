"""The scoring job: which bars lack a score, and what is it?"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.columns import naive_utc
from barline.operators.features import latest_features
from barline.operators.joins import consistency, consistency_gate, skip_existing
from barline.operators.scoring import TreeModel, score_json
from barline.operators.store import Store
from barline.operators.targets import (
    Stamp, at_most, cutoff, incremental_start, key_filter, last_scored, select_incremental, select_ts_list, select_window, window_bounds,
)
from barline.session import cut

ON = ("series", "ts")


@dataclass(frozen=True)
class Backfill:
    """What to score. ``mode`` is ``window``, ``last_from_predictions`` or
    ``ts_list``; ``on_inconsistent`` is ``fail`` or ``keep_valid``.

    ``keep_valid`` scores the targets that have both a bar and features and
    leaves the rest for :func:`barline.operators.joins.consistency` to report.
    ``at_most`` counts per model, and per series unless ``per_series`` is off.
    """

    models: Sequence[TreeModel]
    now: Stamp
    mode: str = "window"
    start: Stamp | None = None
    end: Stamp | None = None
    stamps: DataFrame | None = None
    feature_key: str | None = None
    dataset: str | None = None
    at_most: int | None = None
    per_series: bool = True
    on_inconsistent: str = "fail"
    num_iteration: int | None = None
    method: str = "auto"

    def __post_init__(self) -> None:
        if self.mode not in ("window", "last_from_predictions", "ts_list"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.mode == "ts_list" and self.stamps is None:
            raise ValueError("mode ts_list needs stamps")
        if self.on_inconsistent not in ("fail", "keep_valid"):
            raise ValueError(f"unknown on_inconsistent {self.on_inconsistent!r}")

    @property
    def paths(self) -> list[str]:
        return [m.path for m in self.models]


@dataclass(frozen=True)
class Known:
    """What a store tells a job: the marks of the newest scores, the scores of
    the days the job can touch, and the first time it can touch."""

    marks: DataFrame | None
    scores: DataFrame
    earliest: Stamp | None = None


def select_targets(job: Backfill, bars: DataFrame, scores: DataFrame | Known) -> DataFrame:
    """``series, ts, model_path`` rows to work on, before any skipping."""
    known = scores if isinstance(scores, Known) else Known(scores, scores)
    keys = bars.select(*ON)
    if job.mode == "last_from_predictions":
        rows = select_incremental(keys, known.marks, job.paths, job.now, job.end, job.dataset,
                                  ["series"] if job.per_series else [], known.earliest)
    else:
        if job.mode == "window":
            rows = select_window(keys, job.now, job.start, job.end)
        else:
            rows = select_ts_list(keys, job.stamps, job.now)
        rows = rows.withColumn("model_path", F.explode(F.array(*[F.lit(p) for p in job.paths])))
    return at_most(rows, job.at_most, ["ts", "series"], [*(["series"] if job.per_series else []), "model_path"])


def valid_targets(job: Backfill, bars: DataFrame, features: DataFrame, scores: DataFrame | Known) -> DataFrame:
    """Targets with both a bar and features. In mode ``fail`` this counts the
    others first and raises when there are any."""
    targets = select_targets(job, bars, scores)
    times = targets.select(*ON).distinct()
    if job.on_inconsistent == "fail":
        valid = consistency_gate(times, bars, features, job.feature_key)
    else:
        valid = consistency(times, bars, features, job.feature_key).where("status = 'ok'").select(*ON)
    return targets.join(valid, list(ON), "left_semi")


def dry_run(job: Backfill, bars: DataFrame, features: DataFrame, scores: DataFrame | Known) -> DataFrame:
    """The targets that would be processed, scored already or not."""
    return valid_targets(job, bars, features, scores)


def backfill_scores(job: Backfill, bars: DataFrame, features: DataFrame, scores: DataFrame | Known) -> DataFrame:
    """New score rows ``series, ts, model_path, y_pred, feature_key, dataset``.

    One plan: choose targets, leave out what is scored, take the newest
    features of those bars only, and score them with all models in one pass.
    Bars whose features do not fit a model give no row for it. Targets come
    from the bars, so joining them with the features keeps the consistent ones.

    The models a bar still needs travel with it as a list (at most one entry
    per model of the job), so that nothing is selected twice.
    """
    targets = select_targets(job, bars, scores)
    if job.on_inconsistent == "fail":
        consistency_gate(targets.select(*ON).distinct(), bars, features, job.feature_key)
    todo = skip_existing(targets, scores.scores if isinstance(scores, Known) else scores).groupBy(*ON).agg(F.collect_set("model_path").alias("_models"))
    stored = key_filter(features, job.feature_key).select(*ON, "feature_key", "features", "created_at")
    newest = latest_features(stored.join(todo, list(ON)))
    rows = newest.select(*ON, "feature_key", "features", "_models")
    scored = score_json(rows, job.models, num_iteration=job.num_iteration, method=job.method)
    return scored.where(F.array_contains("_models", F.col("model_path"))).select(
        *ON, "model_path", "y_pred", "feature_key", F.lit(job.dataset).cast("string").alias("dataset"))


def run_backfill(job: Backfill, bars: DataFrame, features: DataFrame, store: Store) -> int:
    """Score and store; returns how many rows were added. A second run with the
    same job adds none. Of the stored scores only the days that the job can
    touch are read; where an incremental job starts is read from the store's marks."""
    store.ensure()
    return store.append_unique(backfill_scores(job, bars, features, known_scores(job, store)))


def known_scores(job: Backfill, store: Store) -> Known:
    """What the job has to know of the store: bounded days in every mode."""
    if job.mode == "window":
        return Known(None, store.read(*window_bounds(job.now, job.start, job.end)))
    last = naive_utc(job.end) if job.end else cutoff(job.now)
    if job.mode == "ts_list":
        span = job.stamps.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
        return Known(None, store.read(last if span.lo is None else span.lo, last if span.hi is None else span.hi))
    marks = cut(store.high_water())
    newest = last_scored(marks.where(F.col("model_path").isin(job.paths)), job.dataset, [*(["series"] if job.per_series else []), "model_path"])
    earliest = incremental_start(newest, job.now, job.end)
    return Known(marks, store.read(earliest, last), earliest)
