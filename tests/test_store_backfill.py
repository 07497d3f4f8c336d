from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barline.operators import store as st
from barline.operators.features import (
    all_match, describe, expected_coverage, feature_parity, features_match_model, latest_features, pack_features,
    parse_features, resolve_feature_ts,
)
from barline.operators.joins import DuplicateKeys, InconsistentData
from barline.operators.scoring import Node, TreeModel
from barline.operators.stats import table_stats
from barline.operators.targets import recent_n
from barline.plans.backfill import Backfill, backfill_scores, dry_run, run_backfill
from barline.streaming.scores import stream_scores

START = datetime(2024, 1, 1)
STUMP = TreeModel("m", ("x",), ({0: Node("x", 10.0, True, 1, 2, None), 1: Node(None, None, False, None, None, -1.0),
                                2: Node(None, None, False, None, None, 1.0)},))


def at(h):
    return START + timedelta(hours=h)


def rows(spark, hours, model="m", y=1.0, key="k", dataset="d"):
    return spark.createDataFrame([("s", at(h), model, y, key, dataset) for h in hours],
                                 "series string, ts timestamp_ntz, model_path string, y_pred double, feature_key string, dataset string")


def seen(store):
    return sorted((int((r.ts - START).total_seconds() // 3600), r.model_path, r.y_pred) for r in store.read().collect())


def test_append_is_all_or_nothing(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure().ensure()
    assert store.append_unique(rows(spark, [1, 2])) == 2
    with pytest.raises(DuplicateKeys, match="already stored"):
        store.append_unique(rows(spark, [2, 3]))
    with pytest.raises(DuplicateKeys, match="batch"):
        store.append_unique(rows(spark, [5, 5]))
    assert store.append_unique(rows(spark, [])) == 0
    assert seen(store) == [(1, "m", 1.0), (2, "m", 1.0)]
    # The same bar under another model or, with the wider key, feature version is another row.
    assert store.append_unique(rows(spark, [1], model="n")) == 1
    wide = st.score_store(spark, str(tmp_path / "t"), st.SCORE_VERSION_KEY).ensure()
    assert wide.append_unique(rows(spark, [1], key="k2")) == 1


def test_opening_checks_the_table_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store = st.score_store(spark, path).ensure()
    store.append_unique(rows(spark, [1, 30]))
    calls = []
    monkeypatch.setattr(st, "require_unique", lambda *a: calls.append(a))
    st.score_store(spark, path).ensure()
    st.score_store(spark, path, st.SCORE_VERSION_KEY).ensure()
    assert not calls
    st.score_store(spark, path, st.SCORE_VERSION_KEY)._write(rows(spark, [60]).withColumn("created_at", F.lit(None)), "append")
    st.score_store(spark, path).ensure()  # the wider key's rows are not known to be unique under this one
    assert len(calls) == 1


def test_bounded_read_prunes_days(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, [1, 30, 60]))
    some = store.read(at(20), at(40))
    assert [r.ts for r in some.collect()] == [at(30)]
    assert len(some.inputFiles()) >= 1 and "PartitionFilters: [isnotnull(day" in some._jdf.queryExecution().toString()


def test_replace_rewrites_only_the_keys(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, [1, 2, 30, 60]))
    store.replace_by_key(rows(spark, [2, 31], y=7.0))
    store.replace_by_key(rows(spark, [2, 31], y=8.0))
    assert seen(store) == [(1, "m", 1.0), (2, "m", 8.0), (30, "m", 1.0), (31, "m", 8.0), (60, "m", 1.0)]


def test_delete_dataset_empties_whole_days(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, [1, 30]))
    store.append_unique(rows(spark, [2, 3], dataset="other"))
    store.append_unique(rows(spark, [4], dataset=None))
    store.delete_dataset("d")
    assert [h for h, *_ in seen(store)] == [2, 3, 4]


def test_stored_duplicates_are_reported(spark, tmp_path):
    path = str(tmp_path / "t")
    st.score_store(spark, path, st.SCORE_VERSION_KEY).ensure().append_unique(rows(spark, [1], key="a"))
    st.score_store(spark, path, st.SCORE_VERSION_KEY).append_unique(rows(spark, [1], key="b"))
    with pytest.raises(DuplicateKeys):
        st.score_store(spark, path).ensure()
    spark.range(3).write.parquet(str(tmp_path / "old"))
    with pytest.raises(st.BadRows):
        st.score_store(spark, str(tmp_path / "old")).ensure()


def test_payload_aliases(spark, tmp_path):
    raw = spark.createDataFrame([
        ("s", "2025-01-01T01:00:00Z", None, "0.1", "m1", None, "k"),
        ("s", None, "2025-01-01 03:00:00+01:00", "0.2", None, "m2", "k")],
        "series string, timestamp string, ts string, y_pred string, model_path string, model_run string, feature_key string")
    store = st.score_store(spark, str(tmp_path / "t"), st.SCORE_VERSION_KEY).ensure()
    assert store.append_unique(st.normalize_payload(raw)) == 2
    newest = recent_n(store.read(), 5).collect()
    assert [(r.ts, r.model_path) for r in newest] == [(datetime(2025, 1, 1, 2), "m2"), (datetime(2025, 1, 1, 1), "m1")]
    stats = table_stats(store.read()).first()
    assert (stats.n_rows, stats.ts_min, stats.ts_max) == (2, datetime(2025, 1, 1, 1), datetime(2025, 1, 1, 2))
    bad = raw.withColumn("feature_key", F.lit(""))
    with pytest.raises(Exception, match="payload lacks"):
        st.normalize_payload(bad).collect()
    assert st.normalize_payload(bad, on_bad="drop").count() == 0


def test_feature_rows_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("s", datetime(2025, 3, 21, 5), 0.1, 1.5, None)],
                               "series string, timestamp timestamp, feat_a double, feat_b double, gone double")
    packed = pack_features(df, ["feat_a", "feat_b", "gone"], "key")
    store = st.feature_store(spark, str(tmp_path / "f"))
    st.upsert_features(store, packed)
    st.upsert_features(store, pack_features(df.withColumn("feat_a", F.lit(0.2)), ["feat_a", "feat_b", "gone"], "key"))
    assert [r.column_name for r in describe(store.read()).orderBy("position").collect()] == [
        "feature_key", "series", "ts", "features", "created_at"]
    [row] = store.read().collect()
    assert json.loads(row.features) == {"feat_a": 0.2, "feat_b": 1.5, "gone": None}
    m = store.read().select(parse_features("features").alias("m")).first().m
    assert m == {"feat_a": 0.2, "feat_b": 1.5, "gone": None}


def test_feature_sets(spark):
    stored = spark.createDataFrame([("s", at(0), "v1", '{"a":1,"b":2}', at(1)), ("s", at(0), "v2", '{"a":1}', at(2)),
                                    ("s", at(1), "v1", "{oops", at(2)), ("s", at(2), "b", '{"q":1}', at(3)),
                                    ("s", at(2), "a", '{"a":1}', at(3))],
                                   "series string, ts timestamp_ntz, feature_key string, features string, created_at timestamp_ntz")
    newest = latest_features(stored).orderBy("ts").collect()
    assert [(r.feature_key, r.features) for r in newest] == [("v2", '{"a":1}'), ("v1", "{oops"), ("a", '{"a":1}')]
    assert [r.feature_key for r in latest_features(stored, "v1").collect()] == ["v1", "v1"]
    got = features_match_model(latest_features(stored, "v1"), ["a", "c"]).orderBy("ts").collect()
    assert [(r.extra, r.missing, r.is_subset, r.is_equal) for r in got] == [(["b"], ["c"], False, False), ([], ["a", "c"], True, False)]
    assert all_match(features_match_model(stored.where("feature_key = 'v2'"), ["a"])).first().all_match
    cover = {r.name: (r.present, r.rows) for r in expected_coverage(stored, ["a", "z"]).collect()}
    assert cover == {"a": (3, 5), "z": (0, 5)}
    assert str(resolve_feature_ts(stored)) == "2024-01-01 02:00:00"
    with pytest.raises(LookupError):
        resolve_feature_ts(stored.limit(0))
    wide = spark.createDataFrame([(1, 2, 3)], "timestamp int, a int, y_ret int")
    assert feature_parity(wide, wide.drop("a")) == ["a"]


@pytest.fixture(scope="module")
def world(spark):
    bars = spark.createDataFrame([("s", at(h)) for h in range(100)], "series string, ts timestamp_ntz")
    features = bars.select("series", "ts", F.lit("v1").alias("feature_key"),
                           F.format_string('{"x":%d}', F.hour("ts")).alias("features"), F.col("ts").alias("created_at"))
    return bars, features


def test_second_run_adds_nothing(spark, tmp_path, world):
    bars, features = world
    store = st.score_store(spark, str(tmp_path / "t"))
    job = Backfill([STUMP], at(61), dataset="d")
    assert run_backfill(job, bars, features, store) == 49
    assert run_backfill(job, bars, features, store) == 0
    first = seen(store)
    assert [h for h, *_ in first] == list(range(12, 61))
    assert all(y == (-1.0 if h % 24 <= 10 else 1.0) for h, _, y in first)
    later = Backfill([STUMP], at(81), mode="last_from_predictions", dataset="d")
    assert run_backfill(later, bars, features, store) == 20
    assert backfill_scores(later, bars, features, store.read()).count() == 0
    assert {r.feature_key for r in store.read().collect()} == {"v1"}


def test_cap_counts_stored_bars_too(spark, tmp_path, world):
    bars, features = world
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, [12, 13]))
    job = Backfill([STUMP], at(61), at_most=5)
    assert sorted(r.ts for r in dry_run(job, bars, features, store.read()).collect()) == [at(h) for h in range(12, 17)]
    assert run_backfill(job, bars, features, store) == 3


def test_inconsistent_data(spark, world):
    bars, features = world
    holes = features.where(F.hour("ts") != 3)
    none = rows(spark, [])
    with pytest.raises(InconsistentData):
        backfill_scores(Backfill([STUMP], at(61)), bars, holes, none)
    kept = backfill_scores(Backfill([STUMP], at(61), on_inconsistent="keep_valid"), bars, holes, none)
    assert kept.count() == 47
    listed = spark.createDataFrame([(at(5),), (at(300),)], "ts timestamp_ntz")
    only = backfill_scores(Backfill([STUMP], at(61), mode="ts_list", stamps=listed), bars, features, none)
    assert [r.ts for r in only.collect()] == [at(5)]
    with pytest.raises(ValueError):
        dry_run(Backfill([STUMP], at(61), mode="nope"), bars, features, none)


def test_stream_scores_each_bar_once(spark, tmp_path, world):
    _, features = world
    source = str(tmp_path / "in")
    columns = [f.split()[0] for f in st.FEATURE_SCHEMA.split(", ")]
    features.select(*columns).where(F.col("ts") < F.lit(str(at(30))).cast("timestamp_ntz")).write.parquet(source)
    store = st.score_store(spark, str(tmp_path / "t"))

    def play(log):
        stream = spark.readStream.schema(st.FEATURE_SCHEMA).parquet(source)
        stream_scores(stream, [STUMP], store, str(tmp_path / log)).awaitTermination()
        return [h for h, *_ in seen(store)]

    assert play("log") == list(range(30))
    features.select(*columns).where(F.col("ts") >= F.lit(str(at(25))).cast("timestamp_ntz")).write.mode("append").parquet(source)
    assert play("log") == list(range(100))
    assert play("fresh log") == list(range(100))
