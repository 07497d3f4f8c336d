"""Queries: scoring and the prediction store."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions.columns import hours
from barline.operators import scoring as sc
from barline.operators import stats
from barline.operators import store as st
from barline.operators.joins import DuplicateKeys
from barline.plans.backfill import Backfill, backfill_scores, dry_run, run_backfill
from barline.plans.files import merge_and_score, score_frame, score_latest_rows
from barline.session import scratch_path
from barline.sources.models import feature_names
from suite.base import (
    CUTOFF, NOW, bars, bars_b, features, features_b, lines, model_trees, models, predictions, query, r6, rq, table,
    user_bars,
)

# The fixture models written out by hand for SQL.
_M1 = """((CASE WHEN {c} <= 3500 OR {c} IS NULL THEN CASE WHEN {r} <= 800 THEN -0.5 ELSE 0.125 END ELSE 0.25 END)
  + (CASE WHEN {r} <= 2500 OR {r} IS NULL THEN 0.0625 ELSE CASE WHEN {c} <= 7000 THEN -0.25 ELSE 1.5 END END))"""
_M2 = "(CASE WHEN {r} <= 0 OR {r} IS NULL THEN 2.0 ELSE CASE WHEN {c} <= 1000 OR {c} IS NULL THEN -1.0 ELSE 0.75 END END)"
_M3 = "(CASE WHEN {v} <= 100 THEN 3.0 ELSE CASE WHEN {c} <= 5000 OR {c} IS NULL THEN -3.0 ELSE 0.5 END END)"
_CLOSE = "cast(json_extract_string({t}.features, '$.close') AS double)"
_RANGE = "cast(json_extract_string({t}.features, '$.range') AS double)"
_VOLUME = "cast(json_extract_string({t}.features, '$.volume') AS double)"


def _m(text: str, t: str) -> str:
    return f"cast({text} AS double)".format(c=_CLOSE.format(t=t), r=_RANGE.format(t=t), v=_VOLUME.format(t=t))


@query("M1_align_strict", "features features_b", """
    SELECT 'a' AS side, series, ts, feature_key, 'missing_features' AS skip_reason FROM features
    UNION ALL SELECT 'b', series, ts, feature_key, NULL FROM features_b
    UNION ALL SELECT 'empty', series, ts, feature_key, 'no_features' FROM features_b""")
def align_strict(spark, sf):
    m3 = models(spark, "m3")[0]
    sides = {"a": features(spark, sf), "b": features_b(spark, sf),
             "empty": features_b(spark, sf).withColumn("features", F.when(F.hour("ts") % 2 == 0, "{}").otherwise("{bad"))}
    out = None
    for name, rows in sides.items():
        made = sc.align_strict(sc.with_feature_map(rows), m3).select(
            F.lit(name).alias("side"), "series", "ts", "feature_key", "skip_reason")
        out = made if out is None else out.unionByName(made)
    return out




@query("M2_align_lenient", "", """
    SELECT o_orderkey, CAST(NULL AS double) AS close, o_totalprice AS volume, try_cast(left(o_orderpriority, 1) AS double) AS rank
    FROM orders""")
def align_lenient(spark, sf):
    wide = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("volume"),
                                             F.substring("o_orderpriority", 1, 1).alias("rank"))
    return sc.align_lenient(wide, ["close", "volume", "rank"], keep=["o_orderkey"])


@query("M3_score", "features", f"""
    SELECT feature_key, series, ts, m.model_path,
      CASE m.model_path WHEN 'm1' THEN {_m(_M1, 'f')} WHEN 'm2' THEN {_m(_M2, 'f')} ELSE {_m(_M3, 'f')} END AS y_pred
    FROM features f CROSS JOIN (VALUES ('m1'), ('m2'), ('m3')) AS m(model_path)""")
def score(spark, sf):
    scored = sc.score_json(features(spark, sf), models(spark), strict=False)
    return scored.select("feature_key", "series", "ts", "model_path", "y_pred")


@query("M3_score_batches", "features node", """
    WITH RECURSIVE x AS (SELECT row_number() OVER () AS id, feature_key, series, ts,
        cast(json_extract_string(features, '$.close') AS double) AS close,
        cast(json_extract_string(features, '$.range') AS double) AS rng FROM features),
    walk(id, tree_id, node_id, leaf_value) AS (
      SELECT x.id, n.tree_id, 0, n.leaf_value FROM x CROSS JOIN node n WHERE n.model_path = 'm1' AND n.node_id = 0
      UNION ALL
      SELECT w.id, w.tree_id, k.node_id, k.leaf_value
      FROM walk w JOIN node n ON n.model_path = 'm1' AND n.tree_id = w.tree_id AND n.node_id = w.node_id
      JOIN x ON x.id = w.id
      JOIN node k ON k.model_path = 'm1' AND k.tree_id = w.tree_id AND k.node_id =
        CASE WHEN (CASE n.feature WHEN 'close' THEN x.close ELSE x.rng END) <= n.threshold THEN n.lc ELSE n.rc END
      WHERE w.leaf_value IS NULL)
    SELECT x.feature_key, x.series, x.ts, sum(w.leaf_value) AS y_pred FROM walk w JOIN x USING (id)
    WHERE w.leaf_value IS NOT NULL GROUP BY x.feature_key, x.series, x.ts""")
def score_batches(spark, sf):
    scored = sc.score_json(features(spark, sf), models(spark, "m1"), strict=False, method="batch")
    return scored.select("feature_key", "series", "ts", "y_pred")


@query("M3_first_iteration", "features", """
    SELECT feature_key, series, ts, cast(CASE WHEN c > 3500 THEN 0.25 WHEN r <= 800 THEN -0.5 ELSE 0.125 END AS double) AS y_pred
    FROM (SELECT *, cast(json_extract_string(features, '$.close') AS double) AS c,
                 cast(json_extract_string(features, '$.range') AS double) AS r FROM features)""")
def score_first(spark, sf):
    rows = sc.with_feature_map(features(spark, sf))
    scored = sc.score_maps(rows, models(spark, "m1")[0], num_iteration=1)
    return scored.select("feature_key", "series", "ts", "y_pred")


@query("M3_score_nan", "bars", f"""
    SELECT series, ts, m.model_path, cast(CASE m.model_path WHEN 'm1' THEN {_M1.format(c="c", r="r")} ELSE {_M2.format(c="c", r="r")} END AS double) AS y_pred
    FROM (SELECT series, ts, CASE WHEN hour(ts) % 4 > 0 THEN close * 100 END AS c, CASE WHEN hour(ts) % 3 > 0 THEN (high - low) * 100 END AS r
          FROM bars WHERE hour(ts) % 5 > 0) x CROSS JOIN (VALUES ('m1'), ('m2')) AS m(model_path)""")
def score_nan(spark, sf):
    """NaN and null values are missing; rows with a feature absent, or no number, are skipped."""
    def value(c, gone):
        return F.when(F.hour("ts") % gone > 0, c.cast("string")).otherwise(F.when(F.dayofmonth("ts") % 2 == 0, "NaN").otherwise("null"))

    close = F.concat(F.lit('"close":'), F.when(F.hour("ts") % 10 == 5, F.lit('"high"')).otherwise(value(F.col("close") * 100, 4)))
    reach = F.concat(F.lit(',"range":'), value((F.col("high") - F.col("low")) * 100, 3))
    text = F.concat(F.lit("{"), close, F.when(F.hour("ts") % 10 == 0, "").otherwise(reach), F.lit(',"note":"x"}'))
    rows = bars(spark, sf).select("series", "ts", text.alias("features"))
    return sc.score_json(rows, models(spark, "m1", "m2")).select("series", "ts", "model_path", "y_pred")


@query("M3_score_averaged", "features", f"""
    SELECT feature_key, series, ts, {_m(_M1, 'f')} / 2 AS y_pred FROM features f""")
def score_averaged(spark, sf):
    trees = model_trees(spark).where("model_path = 'm1'").withColumn("average", F.lit(True))
    return sc.score_json(features(spark, sf), sc.load_models(trees)).select("feature_key", "series", "ts", "y_pred")


# A model by rule: 300 trees of depth 3 over 500 features, sums exact in any order.
_VALUE = "((o_orderkey * 31 + ((t * 7 + n) % 500) * 17 + o_custkey) % 1009)"
_STEP = f"""SELECT o_orderkey, o_custkey, t, CASE WHEN
      CASE WHEN {_VALUE} % 11 = 0 THEN (t + n) % 2 = 0 ELSE {_VALUE} <= (t * 37 + n * 101) % 997 END THEN 2 * n + 1 ELSE 2 * n + 2 END AS n FROM"""


@query("M3_score_many_trees", "", f"""
    WITH a AS ({_STEP} (SELECT o_orderkey, o_custkey, range AS t, 0 AS n FROM orders CROSS JOIN range(300)) x),
    b AS ({_STEP} a), c AS ({_STEP} b)
    SELECT o_orderkey, 'wide' AS model_path, sum(((t * 13 + n * 29) % 201 - 100) / 64) AS y_pred FROM c GROUP BY o_orderkey""")
def score_many_trees(spark, sf):
    def node(t, n):
        if n >= 7:
            return sc.Node(None, None, False, None, None, ((t * 13 + n * 29) % 201 - 100) / 64)
        return sc.Node(f"f{(t * 7 + n) % 500}", float((t * 37 + n * 101) % 997), (t + n) % 2 == 0, 2 * n + 1, 2 * n + 2, None)

    wide = sc.TreeModel("wide", tuple(f"f{i}" for i in range(500)), tuple({n: node(t, n) for n in range(15)} for t in range(300)))
    # A small file is one split, and every row becomes 500 features: rows are dealt out first.
    keys = table(spark, sf, "orders").select("o_orderkey", "o_custkey").repartition(4 * spark.sparkContext.defaultParallelism)
    # Values as columns, so that generated code makes them and the text; a row without a key has no value at all.
    values = keys.select("o_orderkey", *[F.expr(f"(o_orderkey * 31 + {i} * 17 + o_custkey) % 1009").alias(f"f{i}") for i in range(500)])
    made = F.to_json(F.struct(*[F.expr(f"if(f{i} % 11 = 0, null, f{i})").alias(f"f{i}") for i in range(500)]), {"ignoreNullFields": "false"})
    rows = values.select("o_orderkey", F.when(F.col("f0").isNotNull(), made).otherwise("{}").alias("features"))
    return sc.score_json(rows, [wide]).select("o_orderkey", "model_path", "y_pred")


@query("M4_score_file", "", f"""
    SELECT l_orderkey, cast({_M1.format(c="l_extendedprice", r="(l_quantity * 100)")} AS double) AS y_pred, l_linenumber, l_orderkey AS id
    FROM lineitem""")
def score_file(spark, sf):
    wide = lines(spark, sf).select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("id"),
                                   F.col("l_extendedprice").cast("string").alias("close"), (F.col("l_quantity") * 100).alias("range"))
    out = score_frame(wide, models(spark, "m1")[0], id_column="l_orderkey", merge_input=True)
    return out.drop("close", "range")


@query("M5_score_latest_row", "features", f"""
    SELECT series, ts, {_m(_M3, 'f')} AS y_pred FROM (
      SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC, created_at DESC, feature_key) AS rn FROM features) f
    WHERE rn = 1""")
def score_latest(spark, sf):
    return score_latest_rows(features(spark, sf), models(spark, "m3")[0])


@query("M6_backfill_scores", "bars latest predictions", f"""
    SELECT f.series, f.ts, m.model_path, CASE m.model_path WHEN 'm1' THEN {_m(_M1, 'f')} ELSE {_m(_M2, 'f')} END AS y_pred,
           f.feature_key, 'base' AS dataset
    FROM latest f JOIN bars b USING (series, ts) CROSS JOIN (VALUES ('m1'), ('m2')) AS m(model_path)
    LEFT JOIN (SELECT series, model_path, max(ts) AS last_ts FROM predictions WHERE dataset = 'base' GROUP BY series, model_path) p
      ON p.series = f.series AND p.model_path = m.model_path
    WHERE f.ts <= timestamp '{CUTOFF}'
      AND f.ts >= coalesce(p.last_ts + interval '1' hour, timestamp '{CUTOFF}' - interval '48' hour)""")
def backfill(spark, sf):
    job = Backfill(models(spark, "m1", "m2", "m3"), NOW, mode="last_from_predictions", dataset="base",
                   on_inconsistent="keep_valid")
    return backfill_scores(job, bars(spark, sf), features(spark, sf), predictions(spark, sf))


@query("M6_run_backfill", "bars latest predictions", f"""
    SELECT series, ts, model_path, y_pred, feature_key, dataset FROM predictions
    UNION ALL
    SELECT f.series, f.ts, m.model_path, CASE m.model_path WHEN 'm1' THEN {_m(_M1, 'f')} ELSE {_m(_M2, 'f')} END AS y_pred,
           f.feature_key, 'base' AS dataset
    FROM latest f JOIN bars b USING (series, ts) CROSS JOIN (VALUES ('m1'), ('m2')) AS m(model_path)
    LEFT JOIN (SELECT series, model_path, max(ts) AS last_ts FROM predictions WHERE dataset = 'base' GROUP BY series, model_path) p
      ON p.series = f.series AND p.model_path = m.model_path
    WHERE f.ts <= timestamp '{CUTOFF}'
      AND f.ts >= coalesce(p.last_ts + interval '1' hour, timestamp '{CUTOFF}' - interval '48' hour)""")
def backfill_store(spark, sf):
    """Into a store that has scores already; the second run adds nothing."""
    target = st.score_store(spark, scratch_path(spark, "scores")).ensure()
    target.append_unique(predictions(spark, sf))
    job = Backfill(models(spark, "m1", "m2", "m3"), NOW, mode="last_from_predictions", dataset="base", on_inconsistent="keep_valid")
    for _ in range(2):
        run_backfill(job, bars(spark, sf), features(spark, sf), target)
    return target.read().drop("created_at")


@query("M6_backfill_window", "bars features predictions", f"""
    SELECT f.series, f.ts, 'm1' AS model_path, {_m(_M1, 'f')} AS y_pred, f.feature_key, CAST(NULL AS varchar) AS dataset
    FROM features f JOIN (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM bars
      WHERE ts >= timestamp '2024-01-13 00:00:00' AND ts <= timestamp '{CUTOFF}') b USING (series, ts)
    WHERE f.feature_key = 'v2' AND b.rn <= 100
      AND NOT EXISTS (SELECT 1 FROM predictions p WHERE p.series = f.series AND p.ts = f.ts)""")
def backfill_window(spark, sf):
    job = Backfill(models(spark, "m1"), NOW, start="2024-01-13", feature_key="v2", at_most=100,
                   on_inconsistent="keep_valid")
    return backfill_scores(job, bars(spark, sf), features(spark, sf), predictions(spark, sf))


@query("M6_backfill_by_user", "user_bars", f"""
    WITH f AS (SELECT series, ts, concat('{{"close":', cast(cast(round(close * 100) AS bigint) AS varchar), ',"range":',
      cast(cast(round((high - low) * 100) AS bigint) AS varchar), '}}') AS features FROM user_bars WHERE ts <= timestamp '{CUTOFF}')
    SELECT f.series, f.ts, 'm1' AS model_path, {_m(_M1, 'f')} AS y_pred, 'v1' AS feature_key, CAST(NULL AS varchar) AS dataset
    FROM f""")
def backfill_by_user(spark, sf):
    """Every closed bar of every user, none scored before."""
    b = user_bars(spark, sf)
    stored = b.select(F.lit("v1").alias("feature_key"), "series", "ts", F.concat(
        F.lit('{"close":'), F.round(F.col("close") * 100).cast("long").cast("string"), F.lit(',"range":'),
        F.round((F.col("high") - F.col("low")) * 100).cast("long").cast("string"), F.lit("}")).alias("features"),
        F.col("ts").alias("created_at"))
    none = spark.createDataFrame([], st.SCORE_SCHEMA)
    job = Backfill(models(spark, "m1"), NOW, start="2024-01-01", on_inconsistent="keep_valid")
    return backfill_scores(job, b, stored, none)


@query("M7_merge_and_score", "bars bars_b", f"""
    SELECT a.series, a.ts AS "timestamp", cast({_M3.format(c="a.close", v="b.volume")} AS double) AS y_pred
    FROM bars a JOIN bars_b b USING (series, ts)
    WHERE a.ts >= timestamp '2024-01-05 00:00:00' AND a.ts <= timestamp '2024-01-20 00:00:00'""")
def merge_score(spark, sf):
    cur = bars(spark, sf).select("series", F.col("ts").alias("timestamp"), "close")
    norm = bars_b(spark, sf).select("series", F.col("ts").alias("timestamp"), "close", "volume")
    return merge_and_score(cur, norm, models(spark, "m3")[0], "2024-01-05", "2024-01-20", on=("series", "timestamp"))


@query("M8_dry_run_plan", "bars features", f"""
    SELECT b.series, b.ts, 'm1' AS model_path FROM bars b
    WHERE b.ts >= timestamp '2024-01-18 00:00:00' AND b.ts <= timestamp '{CUTOFF}'
      AND EXISTS (SELECT 1 FROM features f WHERE f.series = b.series AND f.ts = b.ts AND f.feature_key = 'v1')""")
def dry_run_plan(spark, sf):
    job = Backfill(models(spark, "m1"), NOW, start="2024-01-18", feature_key="v1", on_inconsistent="keep_valid")
    return dry_run(job, bars(spark, sf), features(spark, sf), predictions(spark, sf))


@query("M9_model_features", "features node", """
    SELECT n.model_path, n.names AS features, f.feature_key, count(*) AS rows,
      count(*) FILTER (list_has_all(json_keys(f.features), string_split(n.names, ','))) AS scorable
    FROM (SELECT model_path, array_to_string(list_sort(list(DISTINCT feature)), ',') AS names FROM node
          WHERE feature IS NOT NULL GROUP BY model_path) n CROSS JOIN features f
    GROUP BY n.model_path, n.names, f.feature_key""")
def model_features(spark, sf):
    """Each model's feature list, and how many stored rows have all of it."""
    names = feature_names(model_trees(spark))
    kinds = features(spark, sf).select("feature_key", F.array_sort(F.json_object_keys("features")).alias("held"))
    counted = kinds.groupBy("feature_key", "held").agg(F.count(F.lit(1)).alias("n"))
    # One entry per model, so that the list is as long as there are models.
    listed = F.array(*[F.struct(F.lit(r.model_path).alias("model_path"), F.array(*map(F.lit, r.features)).alias("features"))
                       for r in names.collect()])
    pairs = counted.withColumn("_m", F.explode(listed)).select("feature_key", "held", "n", "_m.*")
    fits = F.size(F.array_except("features", "held")) == 0
    return pairs.groupBy("model_path", F.array_join("features", ",").alias("features"), "feature_key").agg(
        F.sum("n").alias("rows"), F.sum(F.when(fits, F.col("n")).otherwise(0)).alias("scorable"))


# --- prediction store ------------------------------------------------------

def _new_rows(spark, sf):
    """Half of the stored keys again with new scores, and later bars."""
    fresh = bars(spark, sf).where(F.hour("ts") % 2 == 1).select(
        "series", "ts", F.lit("m1").alias("model_path"), r6(F.col("close") / 50).alias("y_pred"),
        F.lit("v1").alias("feature_key"), F.lit("redo").alias("dataset"), (F.col("ts") + hours(9)).alias("created_at"))
    return fresh


_NEW = f"""(SELECT series, ts, 'm1' AS model_path, {rq("close / 50")} AS y_pred, 'v1' AS feature_key, 'redo' AS dataset,
    ts + interval '9' hour AS created_at FROM bars WHERE hour(ts) % 2 = 1)"""


def _store(spark, sf, rows, key=st.SCORE_KEY):
    target = st.score_store(spark, scratch_path(spark, "scores"), key).ensure()
    target.append_unique(rows)
    return target


@query("P1_ensure_predictions", "predictions",
       "SELECT series, ts, model_path, y_pred, feature_key, dataset, created_at FROM predictions")
def ensure(spark, sf):
    stored = _store(spark, sf, predictions(spark, sf))
    return stored.ensure().read()


@query("P2_normalize_payload", "predictions", """
    SELECT series, ts, y_pred, CASE WHEN hour(ts) % 3 = 0 THEN NULL ELSE model_path END AS model_path, feature_key,
      hour(ts) % 3 = 0 AS bad FROM predictions""")
def payload(spark, sf):
    raw = predictions(spark, sf).select(
        "series", F.when(F.hour("ts") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("ts"),
        F.date_format(F.col("ts") + hours(2), "yyyy-MM-dd HH:mm:ss'+02:00'").alias("timestamp"),
        F.col("y_pred").cast("string").alias("y_pred"), F.lit("").alias("model_path"),
        F.when(F.hour("ts") % 3 != 0, F.col("model_path")).alias("model_run"), "feature_key")
    return st.normalize_payload(raw, on_bad="keep")


@query("P3_append_unique", "bars predictions", f"""
    SELECT series, ts, model_path, y_pred, feature_key, dataset, created_at FROM predictions
    UNION ALL SELECT * FROM {_NEW} n WHERE n.ts >= timestamp '2024-01-15 00:00:00'""")
def append_unique(spark, sf):
    stored = _store(spark, sf, predictions(spark, sf))
    stored.append_unique(_new_rows(spark, sf).where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")))
    return stored.read()


@query("P4_replace_by_key", "bars predictions", f"""
    SELECT * FROM {_NEW} n
    UNION ALL SELECT series, ts, model_path, y_pred, feature_key, dataset, created_at FROM predictions
    WHERE hour(ts) % 2 = 0""")
def replace_by_key(spark, sf):
    stored = _store(spark, sf, predictions(spark, sf))
    stored.replace_by_key(_new_rows(spark, sf))
    return stored.read()


@query("P5_delete_dataset", "predictions", """
    SELECT series, ts, model_path, y_pred, feature_key, 'keep' AS dataset, created_at FROM predictions
    WHERE NOT (y_pred > 0 OR ts < timestamp '2024-01-04 00:00:00')""")
def delete_dataset(spark, sf):
    old = (F.col("y_pred") > 0) | (F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz"))
    stored = _store(spark, sf, predictions(spark, sf).withColumn("dataset", F.when(old, "base").otherwise("keep")))
    stored.delete_dataset("base")
    return stored.read()


@query("P4_compacted", "bars predictions", f"""
    SELECT * FROM {_NEW} n WHERE ts < timestamp '2024-01-10 00:00:00'
    UNION ALL SELECT series, ts, model_path, y_pred, feature_key, 'late' AS dataset, created_at FROM predictions
    WHERE hour(ts) % 2 = 0 AND ts >= timestamp '2024-01-08 00:00:00'""")
def compacted(spark, sf):
    """Replaced, deleted from, merged into one batch, and cleaned up."""
    early = F.lit("2024-01-08").cast("timestamp_ntz")
    stored = _store(spark, sf, predictions(spark, sf).withColumn("dataset", F.when(F.col("ts") < early, "early").otherwise("late")))
    stored.replace_by_key(_new_rows(spark, sf).withColumn("dataset", F.when(
        F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"), "redo").otherwise("gone")))
    stored.delete_dataset("gone")
    stored.compact()
    stored.delete_dataset("early")
    stored.clean()
    return stored.read()


@query("A5_high_water", "bars predictions", f"""
    SELECT series, model_path, dataset, max(ts) AS ts FROM (
      SELECT * FROM {_NEW} n WHERE n.ts < timestamp '2024-01-15 00:00:00'
      UNION ALL SELECT series, ts, model_path, y_pred, feature_key, 'base' AS dataset, created_at FROM predictions
      WHERE hour(ts) % 2 = 0) GROUP BY series, model_path, dataset""")
def high_water(spark, sf):
    """Marks after a replacement that takes the newest rows of a dataset away, and a deleted dataset."""
    stored = _store(spark, sf, predictions(spark, sf))
    fresh = _new_rows(spark, sf)
    later = fresh.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")).withColumn("dataset", F.lit("later"))
    stored.append_unique(later)
    stored.replace_by_key(fresh.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")))
    stored.delete_dataset("later")
    return stored.high_water()


@query("P6_multi_model_coexist", "predictions", """
    SELECT series, ts, cast(3 AS bigint) AS n, true AS enough FROM predictions""")
def coexist(spark, sf):
    base = predictions(spark, sf)
    stored = _store(spark, sf, base, st.SCORE_VERSION_KEY)
    stored.append_unique(st.add_models(base, ["x1", "x2"]))
    return stats.models_per_ts(stored.read(), "v1")


@query("P7_duplicate_rejected", "bars predictions", """
    SELECT b.series, b.ts, 'm1' AS model_path, 'stored' AS reason FROM bars b JOIN predictions p USING (series, ts)
    WHERE hour(b.ts) % 2 = 1
    UNION ALL SELECT series, ts, 'm1', 'twice_in_batch' FROM bars WHERE hour(ts) % 6 = 1""")
def duplicate_rejected(spark, sf):
    batch = _new_rows(spark, sf)
    twice = batch.unionByName(batch.where(F.hour("ts") % 6 == 1))
    return st.append_check(predictions(spark, sf), twice, st.SCORE_KEY)


@query("P7_append_refused", "bars predictions", """
    SELECT series, ts, model_path, y_pred, feature_key, dataset, created_at,
      (SELECT count(*) > 0 FROM bars b JOIN predictions p USING (series, ts) WHERE hour(b.ts) % 2 = 1) AS refused FROM predictions""")
def append_refused(spark, sf):
    """A batch with a stored key is refused as a whole and leaves the store as it was."""
    stored = _store(spark, sf, predictions(spark, sf))
    try:
        stored.append_unique(_new_rows(spark, sf))
        refused = False
    except DuplicateKeys:
        refused = True
    return stored.read().withColumn("refused", F.lit(refused))
