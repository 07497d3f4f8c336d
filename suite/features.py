"""Queries: feature maps and the feature store."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.columns import hours
from barline.operators import features as f
from barline.operators import store as st
from barline.operators import targets as t
from barline.session import scratch_path
from barline.sources.files import feature_list
from suite.base import bars, features, features_b, query, table


@query("W1_latest_features", "latest", "SELECT series, ts, feature_key, features FROM latest")
def latest(spark, sf):
    return f.latest_features(features(spark, sf)).select("series", "ts", "feature_key", "features")


@query("W1_latest_features_of_key", "features",
       "SELECT series, ts, feature_key, features FROM features WHERE feature_key = 'v1'")
def latest_of_key(spark, sf):
    return f.latest_features(features(spark, sf), "v1").select("series", "ts", "feature_key", "features")


@query("F1_parse_features", "features", """
    SELECT 'stored' AS source, series AS id, cast(ts AS varchar) AS sub, feature_key AS version,
      cast(json_extract_string(features, '$.close') AS double) AS x, cast(json_extract_string(features, '$.range') AS double) AS y
    FROM features UNION ALL
    SELECT 'props', cast(event_id AS varchar), '', '', cast(json_extract_string(props, '$.k') AS double), NULL FROM events""")
def parse(spark, sf):
    stored = features(spark, sf).withColumn("m", f.parse_features("features")).select(
        F.lit("stored").alias("source"), F.col("series").alias("id"), F.col("ts").cast("string").alias("sub"),
        F.col("feature_key").alias("version"), F.try_element_at("m", F.lit("close")).alias("x"),
        F.try_element_at("m", F.lit("range")).alias("y"))
    props = table(spark, sf, "events").withColumn("m", f.parse_features("props")).select(
        F.lit("props").alias("source"), F.col("event_id").cast("string").alias("id"), F.lit("").alias("sub"),
        F.lit("").alias("version"), F.try_element_at("m", F.lit("k")).alias("x"), F.lit(None).cast("double").alias("y"))
    return stored.unionByName(props)


@query("F2_json_keys", "features_b features", """
    SELECT feature_key, array_to_string(list_sort(json_keys(features)), ',') AS keys, count(*) AS n FROM (
      SELECT feature_key, features FROM features UNION ALL SELECT 'b', features FROM features_b) GROUP BY ALL""")
def json_keys(spark, sf):
    both = features(spark, sf).select("feature_key", "features").unionByName(
        features_b(spark, sf).select(F.lit("b").alias("feature_key"), "features"))
    named = both.select("feature_key", f.sorted_names(f.feature_keys("features")).alias("keys"))
    return named.groupBy("feature_key", "keys").agg(F.count(F.lit(1)).alias("n"))


@query("F3_features_match_model", "latest features_b", """
    SELECT series, ts, 'a' AS side, '' AS extra, 'volume' AS missing, true AS is_subset, false AS is_equal FROM latest
    WHERE json_keys(features) = ['close', 'range']
    UNION ALL SELECT series, ts, 'b', '', 'range', true, false FROM features_b
    WHERE list_sort(json_keys(features)) = ['close', 'volume']""")
def match_model(spark, sf):
    wanted = ["close", "range", "volume"]
    a = f.features_match_model(f.latest_features(features(spark, sf)), wanted).withColumn("side", F.lit("a"))
    b = f.features_match_model(features_b(spark, sf), wanted).withColumn("side", F.lit("b"))
    both = a.unionByName(b)
    return both.select("series", "ts", "side", F.array_join("extra", ",").alias("extra"),
                       F.array_join("missing", ",").alias("missing"), "is_subset", "is_equal")


@query("F3_all_match", "latest", """
    SELECT bool_and(list_has_all(['close', 'range'], json_keys(features))) AS all_match, count(*) AS n FROM latest""")
def all_match(spark, sf):
    return f.all_match(f.features_match_model(f.latest_features(features(spark, sf)), ["close", "range"]))


@query("F4_config_vs_model", "", """
    WITH c AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS names FROM events GROUP BY user_id)
    SELECT user_id, array_to_string(list_filter(names, lambda x: x NOT IN ('click', 'view', 'error')), ',') AS extra,
      array_to_string(list_filter(['click', 'error', 'view'], lambda x: NOT list_contains(names, x)), ',') AS missing,
      len(list_filter(names, lambda x: x NOT IN ('click', 'view', 'error'))) = 0 AS is_subset,
      names = ['click', 'error', 'view'] AS is_equal FROM c""")
def config_vs_model(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("names"))
    # One half of the lists is written as an object with the key "features".
    text = F.when(F.col("user_id") % 2 == 0, F.to_json("names")).otherwise(
        F.to_json(F.struct(F.col("names").alias("features"))))
    configs = per_user.select("user_id", feature_list(text).alias("features"))
    out = f.config_vs_model(configs, ["click", "view", "error"])
    return out.select("user_id", F.array_join("extra", ",").alias("extra"), F.array_join("missing", ",").alias("missing"),
                      "is_subset", "is_equal")


@query("F5_expected_coverage", "features", """
    SELECT feature_key, e.name, count(*) FILTER (list_contains(json_keys(features), e.name)) AS present, count(*) AS rows
    FROM features CROSS JOIN (VALUES ('close'), ('range'), ('volume')) AS e(name) GROUP BY feature_key, e.name""")
def expected_coverage(spark, sf):
    return f.expected_coverage(features(spark, sf), ["close", "range", "volume"], ["feature_key"])


@query("F6_filter_map", "long_a", "SELECT series, ts, name, value FROM long_a WHERE name IN ('range', 'volume')")
def filter_map(spark, sf):
    rows = t.key_filter(features(spark, sf), "v1")
    return f.explode_features(rows, features=f.filter_map(f.parse_features("features"), ["range", "volume"]))


@query("F7_pack_features", "bars", """
    SELECT 'wide' AS feature_key, series, ts, close AS close_back, high - low AS range_back,
      'close,range' AS names, ts + interval '1' hour AS created_at FROM bars""")
def pack(spark, sf):
    wide = bars(spark, sf).select("series", F.col("ts").alias("timestamp"), "close", (F.col("high") - F.col("low")).alias("range"))
    packed = f.pack_features(wide, ["close", "range"], "wide", created_at=F.col("timestamp") + hours(1))
    m = f.parse_features("features")
    return packed.select("feature_key", "series", "ts", F.element_at(m, "close").alias("close_back"),
                         F.element_at(m, "range").alias("range_back"),
                         f.sorted_names(f.feature_keys("features")).alias("names"), "created_at")


@query("F8_upsert_features", "features features_b", """
    SELECT feature_key, series, ts, features, created_at FROM features_b
    UNION ALL SELECT feature_key, series, ts, features, created_at FROM features f
    WHERE NOT EXISTS (SELECT 1 FROM features_b b WHERE b.feature_key = f.feature_key AND b.series = f.series AND b.ts = f.ts)""")
def upsert(spark, sf):
    target = st.feature_store(spark, scratch_path(spark, "features")).ensure()
    target.append_unique(features(spark, sf))
    st.upsert_features(target, features_b(spark, sf))
    return target.read()


@query("F9_explode_features", "long_a long_b", """
    SELECT 'a' AS side, series, ts, name, value FROM long_a UNION ALL SELECT 'b', series, ts, name, value FROM long_b""")
def explode(spark, sf):
    a = f.explode_features(t.key_filter(features(spark, sf), "v1")).select(F.lit("a").alias("side"), "*")
    return a.unionByName(f.explode_features(features_b(spark, sf)).select(F.lit("b").alias("side"), "*"))


@query("F10_stored_feature_value", "features_b", """
    SELECT series, ts, cast(json_extract_string(features, '$.volume') AS double) AS volume, CAST(NULL AS double) AS "range"
    FROM features_b""")
def stored_value(spark, sf):
    rows = f.feature_value(features_b(spark, sf), "volume", "volume")
    return f.feature_value(rows, "range", "range").select("series", "ts", "volume", "range")


@query("F11_latest_feature_ts", "features", "SELECT series, max(ts) AS ts FROM features GROUP BY series")
def latest_ts(spark, sf):
    return f.latest_feature_ts(features(spark, sf), ["series"])


@query("F12_describe", "features", """
    SELECT d.*, (SELECT count(*) FROM features) AS filled FROM (VALUES (0, 'feature_key', 'string'), (1, 'series', 'string'),
      (2, 'ts', 'timestamp_ntz'), (3, 'features', 'string'), (4, 'created_at', 'timestamp_ntz'))
      AS d("position", column_name, column_type)""")
def describe(spark, sf):
    return f.describe(features(spark, sf), counts=True)


@query("C14_feature_parity", "long_a long_b", """
    SELECT DISTINCT name FROM (SELECT name FROM long_a UNION ALL SELECT 'y_' || name FROM long_a)
    WHERE name NOT LIKE 'y\\_%' ESCAPE '\\' AND name NOT IN (SELECT name FROM long_b)""")
def parity(spark, sf):
    training = f.explode_features(t.key_filter(features(spark, sf), "v1")).select("name")
    targets = training.select(F.concat(F.lit("y_"), "name").alias("name"))
    return f.missing_names(training.unionByName(targets), f.explode_features(features_b(spark, sf)))
