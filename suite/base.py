"""Views over the given tables, in Spark and in SQL, and the query registry."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.columns import hours
from barline.operators.scoring import TreeModel, load_models
from barline.operators.series import ticks_to_bars
from barline.session import prepare, scratch_path

NOW = "2024-01-20 10:25:00"
CUTOFF = "2024-01-20 09:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Six digits, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


# --- views ---------------------------------------------------------------

_STORED: dict[tuple[str, str, str], str] = {}


def stored(build: Callable[[SparkSession, str], DataFrame]):
    """A view kept as a table: written once per session to the shared folder,
    like the bar and score tables the operators are meant for."""

    @functools.wraps(build)
    def read(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, build.__name__)
        if key not in _STORED:
            path = scratch_path(spark, f"view-{build.__name__}")
            build(spark, sf).write.parquet(path)
            _STORED[key] = path
        return spark.read.parquet(_STORED[key])

    return read


@stored
def bars(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "ts", "event_id", "value")
    made = ticks_to_bars(events, series="event_type", order=("ts", "event_id"))
    return made.withColumn("volume", F.round("volume", 6))


@stored
def user_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars per user: many short series instead of a few long ones."""
    events = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("user_id"), "ts", "event_id", "value")
    return ticks_to_bars(events, series="user_id", order=("ts", "event_id"))


@stored
def bars_b(spark: SparkSession, sf: str) -> DataFrame:
    """A second feed: close off by a half at hour 3, hour 4 absent."""
    close = F.when(F.hour("ts") == 3, F.col("close") + 0.5).otherwise(F.col("close"))
    return bars(spark, sf).where(F.hour("ts") != 4).withColumn("close", close)


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long").cast("string")


@stored
def features(spark: SparkSession, sf: str) -> DataFrame:
    b = bars(spark, sf)
    columns = ["feature_key", "series", "ts", "features", "created_at"]
    v1 = b.where(~((F.col("series") == "error") & (F.hour("ts") == 5))).select(
        F.lit("v1").alias("feature_key"), "series", "ts",
        F.concat(F.lit('{"close":'), _cents(F.col("close")), F.lit(',"range":'),
                 _cents(F.col("high") - F.col("low")), F.lit("}")).alias("features"),
        (F.col("ts") + hours(1)).alias("created_at"))
    v2 = b.where(F.hour("ts") % 2 == 0).select(
        F.lit("v2").alias("feature_key"), "series", "ts",
        F.concat(F.lit('{"close":'), _cents(F.col("close")), F.lit(',"range":0}')).alias("features"),
        (F.col("ts") + hours(2)).alias("created_at"))
    return v1.unionByName(v2).select(*columns)


@stored
def features_b(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the second feed: no range, a volume instead."""
    return bars_b(spark, sf).select(
        F.lit("v1").alias("feature_key"), "series", "ts",
        F.concat(F.lit('{"close":'), _cents(F.col("close")), F.lit(',"volume":'),
                 F.round(F.col("volume")).cast("long").cast("string"), F.lit("}")).alias("features"),
        (F.col("ts") + hours(1)).alias("created_at"))


@stored
def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).select(
        "series", "ts", F.lit("m1").alias("model_path"),
        F.round((F.col("close") - F.col("open")) / 100, 6).alias("y_pred"), F.lit("v1").alias("feature_key"),
        F.lit("base").alias("dataset"), (F.col("ts") + hours(3)).alias("created_at"))


@stored
def predictions_b(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.hour("ts") % 7 == 0, F.col("y_pred") + 1e-5).otherwise(F.col("y_pred"))
    return predictions(spark, sf).withColumn("y_pred", moved)


def scored_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("p"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("y"))
    return docs.join(labels, "doc_id")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a unique number to break ties."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag")


# Three models over the stored features. m3 wants a feature no row stores.
MODEL_NODES = [
    # model, tree, node, feature, threshold, default_left, left, right, value
    ("m1", 0, 0, "close", 3500.0, True, 1, 2, None),
    ("m1", 0, 1, "range", 800.0, False, 3, 4, None),
    ("m1", 0, 2, None, None, None, None, None, 0.25),
    ("m1", 0, 3, None, None, None, None, None, -0.5),
    ("m1", 0, 4, None, None, None, None, None, 0.125),
    ("m1", 1, 0, "range", 2500.0, True, 1, 2, None),
    ("m1", 1, 1, None, None, None, None, None, 0.0625),
    ("m1", 1, 2, "close", 7000.0, False, 3, 4, None),
    ("m1", 1, 3, None, None, None, None, None, -0.25),
    ("m1", 1, 4, None, None, None, None, None, 1.5),
    ("m2", 0, 0, "range", 0.0, True, 1, 2, None),
    ("m2", 0, 1, None, None, None, None, None, 2.0),
    ("m2", 0, 2, "close", 1000.0, True, 3, 4, None),
    ("m2", 0, 3, None, None, None, None, None, -1.0),
    ("m2", 0, 4, None, None, None, None, None, 0.75),
    ("m3", 0, 0, "volume", 100.0, False, 1, 2, None),
    ("m3", 0, 1, None, None, None, None, None, 3.0),
    ("m3", 0, 2, "close", 5000.0, True, 3, 4, None),
    ("m3", 0, 3, None, None, None, None, None, -3.0),
    ("m3", 0, 4, None, None, None, None, None, 0.5),
]
NODE_SCHEMA = ("model_path string, tree_id int, node_id int, feature string, threshold double, "
               "default_left boolean, left int, right int, leaf_value double")


def model_trees(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_NODES, NODE_SCHEMA)


def models(spark: SparkSession, *paths: str) -> list[TreeModel]:
    return load_models(model_trees(spark), list(paths) or None)


# --- the same views in SQL -------------------------------------------------

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), """
        SELECT series, h AS ts, max(CASE WHEN a = 1 THEN value END) AS open, max(value) AS high,
               min(value) AS low, max(CASE WHEN z = 1 THEN value END) AS close, round(sum(value), 6) AS volume
        FROM (SELECT event_type AS series, date_trunc('hour', ts) AS h, value,
                row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS a,
                row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts)
                                   ORDER BY ts DESC, event_id DESC) AS z
              FROM events) x
        GROUP BY series, h"""),
    "user_bars": ((), """
        SELECT cast(user_id AS varchar) AS series, date_trunc('hour', ts) AS ts, arg_min(value, (ts, event_id)) AS open,
               max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, sum(value) AS volume
        FROM events GROUP BY ALL"""),
    "bars_b": (("bars",), """
        SELECT series, ts, open, high, low, CASE WHEN hour(ts) = 3 THEN close + 0.5 ELSE close END AS close, volume
        FROM bars WHERE hour(ts) <> 4"""),
    "features": (("bars",), """
        SELECT 'v1' AS feature_key, series, ts,
          concat('{"close":', cast(cast(round(close * 100) AS bigint) AS varchar), ',"range":',
                 cast(cast(round((high - low) * 100) AS bigint) AS varchar), '}') AS features,
          ts + interval '1' hour AS created_at
        FROM bars WHERE NOT (series = 'error' AND hour(ts) = 5)
        UNION ALL
        SELECT 'v2', series, ts, concat('{"close":', cast(cast(round(close * 100) AS bigint) AS varchar),
          ',"range":0}'), ts + interval '2' hour
        FROM bars WHERE hour(ts) % 2 = 0"""),
    "features_b": (("bars_b",), """
        SELECT 'v1' AS feature_key, series, ts,
          concat('{"close":', cast(cast(round(close * 100) AS bigint) AS varchar), ',"volume":',
                 cast(cast(round(volume) AS bigint) AS varchar), '}') AS features,
          ts + interval '1' hour AS created_at
        FROM bars_b"""),
    "predictions": (("bars",), """
        SELECT series, ts, 'm1' AS model_path, round((close - open) / 100, 6) AS y_pred, 'v1' AS feature_key,
          'base' AS dataset, ts + interval '3' hour AS created_at
        FROM bars WHERE ts < timestamp '2024-01-15 00:00:00'"""),
    "predictions_b": (("predictions",), """
        SELECT series, ts, model_path, CASE WHEN hour(ts) % 7 = 0 THEN y_pred + 1e-5 ELSE y_pred END AS y_pred,
          feature_key, dataset, created_at
        FROM predictions"""),
    "scored_docs": ((), """
        SELECT d.doc_id, cast(d.n_chars AS double) AS p, cast(l.quality AS double) AS y
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""),
    "latest": (("features",), """
        SELECT feature_key, series, ts, features, created_at FROM (
          SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY created_at DESC, feature_key) AS rn
          FROM features) WHERE rn = 1"""),
    "long_a": (("features",), """
        SELECT feature_key, series, ts, k AS name, cast(json_extract_string(features, '$.' || k) AS double) AS value
        FROM (SELECT *, unnest(json_keys(features)) AS k FROM features) WHERE feature_key = 'v1'"""),
    "long_b": (("features_b",), """
        SELECT feature_key, series, ts, k AS name, cast(json_extract_string(features, '$.' || k) AS double) AS value
        FROM (SELECT *, unnest(json_keys(features)) AS k FROM features_b)"""),
    "node": ((), "SELECT * FROM (VALUES {rows}) AS n(model_path, tree_id, node_id, feature, threshold, "
             "default_left, lc, rc, leaf_value)".format(rows=", ".join(
                 "({})".format(", ".join(
                     "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool)
                     else f"cast({v} AS double)" if isinstance(v, float) else str(v) for v in n))
                 for n in MODEL_NODES))),
}


def with_views(needed: str, body: str) -> str:
    """``body`` behind the views it needs, in order."""
    order: list[str] = []

    def add(name: str) -> None:
        for parent in VIEWS[name][0]:
            add(parent)
        if name not in order:
            order.append(name)

    for name in needed.split():
        add(name)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in order)
    recursive = "RECURSIVE " if "RECURSIVE" in body else ""
    inner = body.strip()
    if inner.upper().startswith("WITH "):
        inner = inner[5:].strip()
        inner = inner[10:].strip() if inner.upper().startswith("RECURSIVE ") else inner
        return f"WITH {recursive}{ctes},\n{inner}"
    return f"WITH {recursive}{ctes}\n{inner}"


def rq(expr: str) -> str:
    """Six digits, without a negative zero."""
    return f"(CASE WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END)"


# --- registry ---------------------------------------------------------------

@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, views: str = "", sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, with_views(views, sql) if sql else None)
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: q.run for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}
