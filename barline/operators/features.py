"""Feature maps: parsing, key sets, newest version per bar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import col, naive_utc, number
from barline.operators.targets import key_filter

SERIES_TS = ("series", "ts")


def parse_features(json: Column | str) -> Column:
    """``map<string,double>`` of a JSON object. A null value stays a key with a
    missing value; text that is no object gives NULL."""
    parsed = F.from_json(col(json), "map<string,double>")
    return F.transform_values(parsed, lambda _, v: F.when(~F.isnan(v), v))


def feature_keys(json: Column | str) -> Column:
    return F.json_object_keys(col(json))


def sorted_names(names: Column) -> Column:
    """A name set as text, for reports."""
    return F.array_join(F.array_sort(names), ",")


def latest_features(features: DataFrame, feature_key: str | None = None, keys: Sequence[str] = SERIES_TS,
                    newest: str = "created_at") -> DataFrame:
    """The newest stored features per bar, with the feature key they came from.

    Equal ``newest`` values are decided by the smaller feature key, then the
    smaller text. Spark keeps one row per bar on the map side already.
    """
    rows = key_filter(features, feature_key)
    order = Window.partitionBy(*keys).orderBy(F.desc(newest), "feature_key", F.col("features").cast("string"))
    return rows.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def compare_key_sets(stored: Column, expected: Column) -> dict[str, Column]:
    """Columns: extra and missing names, subset and equality tests."""
    extra, missing = F.array_except(stored, expected), F.array_except(expected, stored)
    return {"extra": F.array_sort(extra), "missing": F.array_sort(missing),
            "is_subset": F.size(extra) == 0, "is_equal": (F.size(extra) == 0) & (F.size(missing) == 0)}


def names_array(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")


def features_match_model(latest: DataFrame, model_features: Sequence[str]) -> DataFrame:
    """Stored names against a model's, per row of ``latest``."""
    stored = latest.withColumn("_keys", F.coalesce(feature_keys("features"), F.array().cast("array<string>")))
    return stored.withColumns(compare_key_sets(F.col("_keys"), names_array(model_features))).drop("_keys")


def all_match(matched: DataFrame) -> DataFrame:
    return matched.agg(F.coalesce(F.every("is_subset"), F.lit(False)).alias("all_match"),
                       F.count(F.lit(1)).alias("n"))


def config_vs_model(configs: DataFrame, model_features: Sequence[str]) -> DataFrame:
    """Configured lists (column ``features: array<string>``) against a model's."""
    return configs.withColumns(compare_key_sets(F.col("features"), names_array(model_features)))


def expected_coverage(features: DataFrame, expected: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """How many rows hold each expected feature: ``name, present, rows``.

    Counted over all rows, map-side first.
    """
    held = F.coalesce(feature_keys("features"), F.array().cast("array<string>"))
    rows = features.select(*keys, held.alias("_keys"))
    counts = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.array_contains("_keys", n)).alias(f"_p{i}") for i, n in enumerate(expected)])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"_p{i}").alias("present"))
                      for i, n in enumerate(expected)])
    return counts.select(*keys, "rows", F.explode(pairs).alias("_e")).select(*keys, "_e.name", "_e.present", "rows")


def filter_map(features: Column, names: Sequence[str]) -> Column:
    """Only the listed features; an empty list keeps all."""
    if not names:
        return features
    listed = names_array(names)
    return F.map_filter(features, lambda k, _: F.array_contains(listed, k))


def pack_features(df: DataFrame, columns: Sequence[str], feature_key: str, *, ts: str = "timestamp",
                  keys: Sequence[str] = ("series",), created_at: Column | None = None) -> DataFrame:
    """Wide feature rows to store rows ``feature_key, keys, ts, features,
    created_at``, with the features as JSON text."""
    entries = [x for c in columns for x in (F.lit(c), number(F.col(f"`{c}`")))]
    text = F.to_json(F.create_map(*entries), {"ignoreNullFields": "false"})
    return df.select(F.lit(feature_key).alias("feature_key"), *keys, F.col(ts).cast("timestamp_ntz").alias("ts"),
                     text.alias("features"),
                     (created_at if created_at is not None else F.current_timestamp()).cast("timestamp_ntz")
                     .alias("created_at"))


def explode_features(df: DataFrame, keys: Sequence[str] = SERIES_TS, features: Column | None = None) -> DataFrame:
    """Long form ``keys, name, value``."""
    parsed = features if features is not None else parse_features("features")
    return df.select(*keys, F.explode(parsed).alias("name", "value"))


def feature_value(df: DataFrame, name: str, out: str = "value") -> DataFrame:
    """One feature per row; NULL where the row lacks it."""
    return df.withColumn(out, F.try_element_at(parse_features("features"), F.lit(name)))


def latest_feature_ts(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return features.groupBy(*keys).agg(F.max("ts").alias("ts"))


def resolve_feature_ts(features: DataFrame, explicit: str | None = None):
    """The time to check: the given one, else the newest stored (an action)."""
    if explicit:
        return naive_utc(explicit)
    newest = latest_feature_ts(features).first().ts
    if newest is None:
        raise LookupError("the feature store is empty")
    return naive_utc(newest)


def describe(df: DataFrame, counts: bool = False) -> DataFrame:
    """Column names and types, in order; with ``counts`` also how many rows
    have a value, counted in one pass over the table."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    described = df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")
    if not counts:
        return described
    filled = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.col(f"_{i}").alias("filled")) for i, _, _ in rows])
    return described.join(filled.select(F.explode(pairs).alias("_e")).select("_e.*"), "position")


def feature_parity(training: DataFrame, computed: DataFrame) -> list[str]:
    """Training columns (without time and ``y_*``) that were not computed."""
    return [c for c in training.columns
            if c not in ("timestamp", "series") and not c.startswith("y_") and c not in computed.columns]


def missing_names(training: DataFrame, computed: DataFrame) -> DataFrame:
    """The same over long feature rows: training names no computed row has."""
    wanted = training.select("name").distinct().where(~F.col("name").startswith("y_"))
    return wanted.join(computed.select("name").distinct(), "name", "left_anti")
