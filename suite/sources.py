"""Queries: readers, normalisers and writers.

Files a reader needs are written first, from the given tables, to a scratch
folder of the session's shared directory.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from barline.functions.columns import coerce_numeric, epoch_micros, require_columns
from barline.functions.scans import positions
from barline.operators.scoring import load_models, score_maps, with_feature_map
from barline.operators.series import generate_targets
from barline.session import scratch_path
from barline.sources import files, sinks, tables
from barline.sources.models import latest_model, read_model_trees
from suite.base import bars, features, lines, predictions, query, r6, rq, table

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Fixed value: above 32 folders Spark lists them in tasks.
FOLDERS = 128


def _folder(spark, label):
    return scratch_path(spark, label)


def _dealt(df, key):
    """Rows dealt to FOLDERS folders by their key, each folder in one task."""
    folder = F.format_string("%03d", F.pmod(F.hash(key), F.lit(FOLDERS)))
    return df.withColumn("folder", folder).repartition(FOLDERS, "folder")


def _csv(df, path):
    df.write.option("header", "true").csv(path)
    return path


@query("S1_read_bars", "bars", """
    SELECT series, ts, open, high, low, close, volume FROM bars
    WHERE ts BETWEEN timestamp '2024-01-03 00:00:00' AND timestamp '2024-01-22 12:00:00'""")
def read_bars(spark, sf):
    path = _folder(spark, "bars") + ".parquet"
    bars(spark, sf).write.parquet(path)
    return tables.read_bars(spark, path, "2024-01-03", "2024-01-22 12:00:00")


@query("S2_read_csv_bars", "bars", """
    SELECT series, ts AS "timestamp", open, high, low, close, CASE WHEN hour(ts) = 7 THEN NULL ELSE volume END AS volume
    FROM bars""")
def read_csv_bars(spark, sf):
    b = bars(spark, sf)
    raw = b.select(
        F.col("series").alias(" Series"), F.date_format("ts", _ISO).alias("Timestamp "), F.col("open").alias("OPEN"),
        F.col("high").alias("High"), F.col("low").alias("low"), F.col("close").alias(" Close"),
        F.when(F.hour("ts") == 7, F.lit("n/a")).otherwise(F.col("volume").cast("string")).alias("Volume"))
    bad = raw.limit(1).withColumn("Timestamp ", F.lit("not a time"))
    path = _csv(raw.unionByName(bad), _folder(spark, "csv"))
    return tables.read_csv_bars(spark, path, ["series"])


@query("S3_read_any", "bars", """
    SELECT 'csv' AS kind, series, cast(close AS double) AS close FROM bars
    UNION ALL SELECT 'parquet', series, close FROM bars""")
def read_any(spark, sf):
    b = bars(spark, sf).select("series", "close")
    base = _folder(spark, "any")
    b.write.option("header", "true").csv(base + ".csv")
    b.write.parquet(base + ".parquet")
    as_csv = coerce_numeric(tables.read_any(spark, base + ".csv"), ["close"])
    both = as_csv.select(F.lit("csv").alias("kind"), "*")
    return both.unionByName(tables.read_any(spark, base + ".parquet").select(F.lit("parquet").alias("kind"), "*"))


@query("S4_resolve_ts_column", "", """
    SELECT 'named' AS how, event_id, ts AS "timestamp" FROM events UNION ALL SELECT 'first', event_id, ts FROM events""")
def resolve_ts_column(spark, sf):
    e = table(spark, sf, "events").select("event_id", "ts")
    named = tables.resolve_time(e.withColumnRenamed("ts", "time").withColumn("date", F.lit("2020-01-01"))).drop("date")
    first = tables.resolve_time(e.select(F.col("ts").alias("when"), "event_id"))
    return named.select(F.lit("named").alias("how"), "*").unionByName(first.select(F.lit("first").alias("how"), "*"))


@query("S5_normalize_ts", "", """
    SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE date_trunc('second', ts) END AS ts FROM events""")
def normalize_ts(spark, sf):
    ts = F.col("ts")
    text = (F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_id") % 4 == 1, F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'"))
            .when(F.col("event_id") % 4 == 2, F.concat(F.lit("  "), F.date_format(ts, _ISO)))
            .otherwise(F.concat(F.lit("x"), ts.cast("string"))))
    return table(spark, sf, "events").select("event_id", tables.parse_ts(text).alias("ts"))


@query("S6_epoch_ms_ts", "", "SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def epoch_ms(spark, sf):
    raw = table(spark, sf, "events").select("event_id", F.floor(epoch_micros("ts") / 1000).cast("string").alias("open_time"))
    return raw.select("event_id", tables.bar_time(raw).alias("ts"))


@query("S7_dedup_keep_first", "", """
    SELECT series, h, event_id FROM (SELECT event_type AS series, date_trunc('hour', ts) AS h, event_id,
      row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def dedup(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("series"), tables.parse_ts(
        F.date_trunc("hour", "ts")).alias("h"), "event_id")
    return tables.dedup(e, ["series", "h"], [F.col("event_id")])


@query("S8_union_splits", "predictions", f"""
    SELECT series, ts AS "timestamp", {rq("CASE WHEN ts >= timestamp '2024-01-08 00:00:00' THEN y_pred + 1 ELSE y_pred END")} AS y_pred
    FROM predictions""")
def union_splits(spark, sf):
    base = _folder(spark, "splits")
    p = predictions(spark, sf).select(F.col("ts").cast("string").alias("timestamp"), "series", "y_pred")
    _csv(p, f"{base}/pred_a.csv")
    # The later file wins for its times; a file without scores is skipped.
    _csv(p.where("timestamp >= '2024-01-08'").withColumn("y_pred", F.col("y_pred") + 1), f"{base}/pred_b.csv")
    _csv(p.drop("y_pred"), f"{base}/pred_c.csv")
    return tables.union_splits(spark, base, keys=["series"]).withColumn("y_pred", r6("y_pred"))


@query("S9_coerce_numeric", "", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS x,
      try_cast(left(o_orderpriority, 1) AS double) AS y FROM orders""")
def coerce(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit("NaN")).otherwise(F.col("o_totalprice").cast("string")).alias("x"),
        F.substring("o_orderpriority", 1, 1).alias("y"))
    return coerce_numeric(raw, ["x", "y"])


@query("S10_require_columns", "bars", "SELECT series, ts, open, high, low, close, volume FROM bars")
def require(spark, sf):
    b = bars(spark, sf)
    try:
        require_columns(b.drop("high"), ["open", "high"])
    except ValueError:
        return require_columns(b, ["open", "high", "low", "close", "volume"])
    raise AssertionError("a missing column went unnoticed")


@query("S11_pick_value_column", "predictions", """
    SELECT series, ts AS "timestamp", y_pred FROM predictions WHERE hour(ts) <> 2""")
def pick_value(spark, sf):
    raw = predictions(spark, sf).select("series", F.col("ts").alias("timestamp"), F.lit(1).alias("y"),
                                        F.when(F.hour("ts") != 2, F.col("y_pred")).alias("pred"))
    return tables.pick_score(raw, keys=["series"])


@query("S12_parse_ts_list", "", "SELECT DISTINCT o_orderdate AS ts FROM orders")
def parse_ts_list(spark, sf):
    stamps = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("s"))
    return files.distinct_times(stamps.unionByName(stamps.select(F.concat(F.lit("?"), "s").alias("s"))), "s")


@query("S13_read_ts_file", "", "SELECT DISTINCT date_trunc('second', ts) AS ts FROM events")
def read_ts_file(spark, sf):
    path = _folder(spark, "times")
    lines_ = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("v"))
    lines_.unionByName(lines_.select(F.lit("  ").alias("v"))).write.text(path)
    none = files.read_ts_file(spark, path + "-absent")
    return files.read_ts_file(spark, path).unionByName(none)


@query("S14_read_feature_list", "", """
    SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS names FROM events
    GROUP BY user_id HAVING user_id % 3 <> 2 UNION ALL SELECT DISTINCT user_id, '' FROM events WHERE user_id % 3 = 2""")
def read_feature_list(spark, sf):
    per_user = table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("n"))
    text = (F.when(F.col("user_id") % 3 == 0, F.to_json("n"))
            .when(F.col("user_id") % 3 == 1, F.to_json(F.struct(F.col("n").alias("features")))).otherwise("not json"))
    path = _folder(spark, "lists")
    name = F.concat(F.coalesce(F.col("user_id").cast("string"), F.lit("none")), F.lit(".json"))
    sinks.write_files(_dealt(per_user, "user_id").select("folder", name.alias("name"), text.alias("content")), path)
    read = files.read_feature_list(spark, path, recursive=True)
    user = F.regexp_extract("path", r"([^/]+)[.]json$", 1).try_cast("long")
    return read.select(user.alias("user_id"), F.array_join("features", ",").alias("names"))


@query("S15_read_run_metadata", "", """
    SELECT user_id, 'metrics.json' AS file, cast(count(*) AS bigint) AS n FROM events WHERE user_id % 10 <> 9 GROUP BY user_id""")
def read_run_metadata(spark, sf):
    base = _folder(spark, "runs")
    counted = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    body = F.when(F.col("user_id") % 10 == 9, F.lit("{broken")).otherwise(F.to_json(F.struct("n")))
    run = F.concat_ws("/", "folder", F.concat(F.lit("user_id="), F.coalesce(
        F.col("user_id").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))))
    sinks.write_files(_dealt(counted, "user_id").select(
        run.alias("folder"), F.lit("metrics.json").alias("name"), body.alias("content")), base)
    meta = files.read_run_metadata(spark, base)
    user = F.regexp_extract("run", "user_id=([0-9]+)", 1).cast("long")
    return meta.select(user.alias("user_id"), "file", F.get_json_object("content", "$.n").cast("long").alias("n"))


def _write_model(spark, folder, cut):
    """A one-tree model whose threshold comes from the data."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    text = "\n".join([
        "tree", "version=v4", "num_class=1", "num_tree_per_iteration=1", "label_index=0", "max_feature_idx=1",
        "objective=regression", "feature_names=close range", "", "Tree=0", "num_leaves=2", "num_cat=0",
        "split_feature=0", "split_gain=1", f"threshold={cut!r}", "decision_type=10", "left_child=-1", "right_child=-2",
        "leaf_value=-1.5 2.5", "is_linear=0", "shrinkage=1", "", "end of trees", ""])
    path = hadoop.Path(folder, "model.txt")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(text.encode()))
    out.close()


@query("S16_latest_model", "features", """
    WITH x AS (SELECT feature_key, series, ts, cast(json_extract_string(features, '$.close') AS double) AS close FROM features)
    SELECT feature_key, series, ts, cast(CASE WHEN close <= (SELECT avg(close) FROM x) THEN -1.5 ELSE 2.5 END AS double) AS y_pred FROM x""")
def latest_model_scores(spark, sf):
    """The newest model file under a root scores every stored row."""
    root = _folder(spark, "models")
    rows = with_feature_map(features(spark, sf))
    mean = rows.agg(F.avg(F.element_at("feature_map", "close")).alias("m")).first().m
    _write_model(spark, root + "/run_old", mean * 3)
    time.sleep(0.05)
    _write_model(spark, root + "/run_new", mean)
    model = load_models(read_model_trees(spark, latest_model(spark, root)))[0]
    return score_maps(rows, model).select("feature_key", "series", "ts", "y_pred")


@query("S17_latest_file", "bars", "SELECT series, ts, close FROM bars WHERE hour(ts) % 2 = 0")
def latest_file(spark, sf):
    base = _folder(spark, "latest")
    b = bars(spark, sf).select("series", "ts", "close")
    b.write.parquet(base + "/features_old.parquet")
    time.sleep(0.05)
    b.where(F.hour("ts") % 2 == 0).write.parquet(base + "/features_new.parquet")
    # Spark writes a folder of files: the newest file tells the newest folder.
    newest = files.latest_file(spark, base, "part-*.parquet", recursive=True)
    return spark.read.parquet(newest.rsplit("/", 1)[0])


@query("S18_write_targets_csv", "bars", f"""
    SELECT series, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", 'y_ret_12h' AS target_name, {rq("c / close - 1")} AS y_true,
      '12' AS horizon_bars, '12h' AS target_label FROM (
      SELECT *, lead(close, 12) OVER (PARTITION BY series ORDER BY ts) AS c FROM bars)
    WHERE c IS NOT NULL AND close <> 0""")
def write_targets(spark, sf):
    path = _folder(spark, "targets")
    rows = generate_targets(bars(spark, sf), start="2024-01-01", horizon=12, log=False)
    sinks.write_targets_csv(rows, path, ("series",))
    back = spark.read.option("header", "true").csv(path).drop("feature_key")
    return back.withColumn("y_true", r6(F.col("y_true").cast("double")))


@query("S19_write_predictions_csv", "", """
    SELECT cast(l_orderkey AS varchar) AS l_orderkey, l_extendedprice AS y_pred, cast(l_linenumber AS varchar) AS l_linenumber
    FROM lineitem""")
def write_predictions(spark, sf):
    path = _folder(spark, "preds")
    scored = lines(spark, sf).select("l_linenumber", F.col("l_extendedprice").alias("y_pred"), "l_orderkey")
    sinks.write_predictions_csv(scored, path, "l_orderkey", merge_input=True)
    back = spark.read.option("header", "true").csv(path)
    return require_columns(back, ["l_orderkey", "y_pred", "l_linenumber"]).withColumn("y_pred", F.col("y_pred").cast("double"))


@query("S20_read_split_rows", "bars", """
    SELECT CASE WHEN hour(ts) % 2 = 0 THEN 'even' ELSE 'odd' END AS split, series, ts AS "timestamp", close FROM bars""")
def read_split_rows(spark, sf):
    """Positions per split are kept in the data; the lists hold the times. A
    split is one day here, so that no list grows with the data."""
    split = F.concat_ws("_", F.when(F.hour("ts") % 2 == 0, "even").otherwise("odd"), "series",
                        F.date_format("ts", "yyyyMMdd"))
    rows = bars(spark, sf).select(split.alias("split"), "series", "ts", "close")
    rows = positions(rows, ["split"], ["ts"], name="row_idx").withColumn("row_idx", F.col("row_idx").cast("int"))
    ordered = rows.groupBy("split").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row_idx", F.col("ts").cast("string").alias("s")))),
                    lambda x: x["s"]).alias("stamps"))
    lists = ordered.select(F.create_map("split", "stamps").alias("split_timestamps"))
    joined = tables.read_split_rows(lists, rows.drop("ts"))
    return joined.select(F.regexp_extract("split", "^[a-z]+", 0).alias("split"), "series", "timestamp", "close")
