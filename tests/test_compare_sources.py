from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barline.operators import compare as c
from barline.operators import stats
from barline.sources import files, sinks, tables
from barline.sources.files import feature_list

START = datetime(2024, 1, 1)


def at(h):
    return START + timedelta(hours=h)


def series(spark, values, name="v"):
    return spark.createDataFrame([("s", at(h), v) for h, v in enumerate(values)], f"series string, ts timestamp_ntz, {name} double")


A = [1.0, 2.0, None, 4.0, None, 6.0]
B = [1.0, 2.5, 3.0, None, None, 5.0]


def test_one_sided_values(spark):
    """The four rules for a value that only one side has."""
    pairs = c.long_pairs(series(spark, A), series(spark, B), ["v"])
    bars = c.diff_stats_nonzero(pairs).first()
    assert (bars.n_rows, bars.n_diff, bars.mean_diff, bars.median_diff, bars.min_diff, bars.max_diff) == (6, 5, 0.25, 0.25, -0.5, 1.0)
    wide = c.compare_features_wide(series(spark, A), series(spark, B)).first()
    assert (wide.n_diff, wide.mean_diff) == (2, 0.25)
    long_a, long_b = (c.wide_to_long(series(spark, x), ["v"]) for x in (A, B))
    maps = {r.ts: r.status for r in c.compare_maps(long_a, long_b).collect()}
    assert [maps[at(h)] for h in range(6)] == ["equal", "mismatch", "mismatch", "mismatch", "equal", "mismatch"]
    keyed = [series(spark, x, "y_pred").withColumn("created_at", F.col("ts")) for x in (A, B)]
    assert c.compare_preds_tol(*keyed, ["series", "ts"]).first().asDict() == {"n_common": 6, "n_mismatch": 2}


def test_all_differences(spark):
    got = c.diff_stats_all(c.long_pairs(series(spark, A), series(spark, B), ["v"])).first()
    assert (got.n_rows, got.n_diff, round(got.mean_diff, 9), got.median_diff) == (6, 5, round(0.5 / 3, 9), 0.0)


def test_missing_names(spark):
    schema = "series string, ts timestamp_ntz, name string, value double"
    a = spark.createDataFrame([("s", at(0), "x", 1.0), ("s", at(0), "only_a", 1.0)], schema)
    b = spark.createDataFrame([("s", at(0), "x", 1.0 + 1e-12), ("s", at(0), "only_b", 1.0)], schema)
    assert {r.name: r.status for r in c.compare_maps(a, b).collect()} == {
        "x": "equal", "only_a": "missing_in_b", "only_b": "missing_in_a"}
    targets = spark.createDataFrame([("s", at(0)), ("s", at(9))], "series string, ts timestamp_ntz")
    verdicts = {r.ts: r.verdict for r in c.compare_batch(a, b, targets).collect()}
    assert verdicts == {at(0): "mismatch", at(9): "skip"}
    totals = c.batch_totals(c.compare_batch(a, a, targets)).first()
    assert (totals.compared, totals.ok, totals.failed) == (2, 1, 1)


def test_relative_comparison_ignores_tiny_references(spark):
    a = series(spark, [1.0, 0.0, 1000.0, 1.0], "y_pred")
    b = series(spark, [1.0005, 5.0, 1000.5, 1.0 + 1e-8], "y_pred")
    got = c.compare_preds_rel(a, b, ["series", "ts"]).first()
    assert (got.n_common, got.n_mismatch, got.max_abs_diff) == (4, 2, 5.0)
    assert abs(got.max_rel_diff - 0.0005) < 1e-12


def test_top_k_and_divergence(spark):
    a = series(spark, [0.0, 0.0, 5.0, 5.0, -9.0, 1.0])
    b = series(spark, [0.0, 0.0, 4.0, 8.0, 0.0, 1.0])
    top = c.top_k_abs_diff(c.long_pairs(a, b, ["v"]), 2).orderBy("rank").collect()
    assert [(r.ts, r.abs_diff) for r in top] == [(at(4), 9.0), (at(3), 3.0)]
    first = c.first_divergence(a, b, "v").first()
    assert (first.first_ts, first.delta, first.prev_ts, first.prev_delta) == (at(2), 1.0, at(1), 0.0)
    assert c.first_divergence(a, a, "v").count() == 0
    at_once = c.first_divergence(a, b.withColumn("v", F.col("v") + 1), "v").first()
    assert (at_once.first_ts, at_once.prev_ts) == (at(0), None)


def test_identical_frames(spark):
    a = series(spark, [1.0, 1.0])
    assert c.frames_identical(a, a.orderBy(F.desc("ts"))).first().identical
    assert not c.frames_identical(a, a.unionByName(a.limit(1))).first().identical
    assert not c.frames_identical(a, a.withColumn("v", F.col("v").cast("float"))).first().identical


def test_lookbacks(spark):
    schema = ("series string, timeframe string, ts timestamp_ntz, bar_ts timestamp_ntz, open double, high double, "
              "low double, close double, volume double")
    row = lambda h, x=1.0: ("s", "1H", at(5), at(h), x, x, x, x, None)
    a = spark.createDataFrame([row(1), row(2), row(3)], schema)
    moved = spark.createDataFrame([row(1), row(2, 1.5), row(3)], schema)
    short = spark.createDataFrame([row(2), row(3)], schema)
    assert c.compare_lookbacks(a, a).first().ok
    bad = c.compare_lookbacks(a, moved).first()
    assert (bad.ok, bad.same_index, bad.mism_close, bad.max_close, bad.mism_volume) == (False, True, 1, 0.5, 0)
    less = c.compare_lookbacks(a, short).first()
    assert (less.ok, less.same_index, less.n_a, less.n_b, less.mism_close) == (False, False, 3, 2, 0)
    whole = spark.createDataFrame([("s", at(5), True)], "series string, ts timestamp_ntz, continuous boolean")
    for stored, verdict in ((a, "ok"), (moved, "diff"), (a.limit(0), "missing")):
        assert c.compare_lookbacks_batch(stored, a, whole).first().verdict == verdict
    broken = whole.withColumn("continuous", F.lit(False))
    assert c.batch_verdict(c.compare_lookbacks_batch(a, a, broken)).first().asDict() == {"n": 1, "n_ok": 0, "all_ok": False}


def test_snapshot_of_an_absent_key(spark):
    schema = "series string, timeframe string, ts timestamp_ntz, ts_key string, bar_ts timestamp_ntz, close double"
    store = spark.createDataFrame([("s", "1H", at(5), "k", at(h), float(h)) for h in (4, 5)], schema)
    wanted = spark.createDataFrame([("s", "1H", at(5)), ("s", "1H", at(90))], "series string, timeframe string, ts timestamp_ntz")
    got = {r.ts: (r.found, r.n_rows, r.last_close, r.nearest_ts) for r in c.snapshot_summary(store, wanted).collect()}
    assert got == {at(5): (True, 2, 5.0, at(5)), at(90): (False, 0, None, at(5))}


def test_win_rate_without_outcomes(spark):
    sig = spark.createDataFrame([("s", 1)], "series string, x int")
    none = spark.createDataFrame([], "series string, outcome_sign double")
    got = stats.win_rate(sig, none).first()
    assert (got.signals, got.evaluated, got.wins, got.losses, got.win_rate) == (1, 0, 0, 0, None)
    some = spark.createDataFrame([("s", 1.0), ("s", None), ("s", 0.0)], "series string, outcome_sign double")
    got = stats.win_rate(sig, some).first()
    assert (got.evaluated, got.wins, got.losses, round(got.win_rate, 6)) == (3, 1, 2, 33.333333)


def test_diff_summary_skips_what_is_not_finite(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (float("inf"), 1.0), (None, 1.0)], "a double, b double")
    got = stats.diff_summary(df, F.col("a"), F.col("b")).first()
    assert got.asDict() == {"max_diff": 1.0, "mean_diff": 0.5, "n_nonzero": 1, "n": 2}


def test_csv_bars(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(" Open_Time ,OPEN,High,low,Close,Volume\n1704067200000,1,2,0.5,x,10\n1704067200000,9,9,9,9,9\n"
                    "oops,1,1,1,1,1\n1704070800000,2,2,2,2,\n")
    rows = tables.read_csv_bars(spark, str(path)).orderBy("timestamp").collect()
    assert [(r.timestamp, r.open, r.close, r.volume) for r in rows] == [(at(0), 1.0, None, 10.0), (at(1), 2.0, 2.0, None)]
    bad = tmp_path / "y.csv"
    bad.write_text("time,open,high,low\n2024-01-01,1,1,1\n")
    with pytest.raises(ValueError, match="close"):
        tables.read_csv_bars(spark, str(bad))
    bad.write_text("day,open,high,low,close,volume\n1,1,1,1,1,1\n")
    with pytest.raises(ValueError, match="time column"):
        tables.read_csv_bars(spark, str(bad))


def test_splits_last_occurrence_wins(spark, tmp_path):
    (tmp_path / "pred_test.csv").write_text("timestamp,y_pred\n2024-01-01,1\n2024-01-01,2\n2024-01-02,\n")
    (tmp_path / "pred_train.csv").write_text("when,y_pred\n2024-01-03,3\n2024-01-01,7\n")
    (tmp_path / "pred_val.csv").write_text("nothing,here\n1,2\n")
    rows = tables.union_splits(spark, str(tmp_path)).orderBy("timestamp").collect()
    assert [(r.timestamp.day, r.y_pred) for r in rows] == [(1, 7.0), (3, 3.0)]
    other = tmp_path / "other"
    other.mkdir()
    with pytest.raises(FileNotFoundError):
        tables.union_splits(spark, str(other))


def test_split_rows_by_position(spark):
    splits = spark.sql("select map('train', array('2024-01-01', '2024-01-02'), 'test', array('2024-01-03')) as split_timestamps")
    rows = spark.createDataFrame([("train", 1, 5.0), ("train", 0, 4.0), ("test", 0, 6.0), ("test", 9, 0.0)],
                                 "split string, row_idx int, f double")
    got = sorted((r.timestamp.day, r.f) for r in tables.read_split_rows(splits, rows).collect())
    assert got == [(1, 4.0), (2, 5.0), (3, 6.0)]


def test_lists(spark, tmp_path):
    texts = ['["a","b"]', '{"features":["c"],"x":1}', "{}", "nope", None, '"a"']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    assert [r.f for r in df.select("i", feature_list(F.col("t")).alias("f")).orderBy("i").collect()] == [
        ["a", "b"], ["c"], [], [], [], []]
    with pytest.raises(Exception, match="expected a JSON list"):
        df.where("i = 3").select(feature_list(F.col("t"), strict=True)).collect()
    path = tmp_path / "f.json"
    path.write_text('{\n "features": ["p",\n "q"]}')
    assert files.read_feature_list(spark, str(path)).first().features == ["p", "q"]
    stamps = tmp_path / "t.txt"
    stamps.write_text("2024-01-02\n\n  2024-01-01T02:00:00+02:00 \nx\n2024-01-02\n")
    assert sorted(r.ts for r in files.read_ts_file(spark, str(stamps)).collect()) == [at(0), at(24)]
    assert files.read_ts_file(spark, str(tmp_path / "absent")).count() == 0
    assert files.parse_ts_list(spark, ["2024-01-01", "?", "2024-01-01"]).count() == 1


def test_metadata_is_best_effort(spark, tmp_path):
    for run, name, text in [("r1", "metrics.json", '{"auc": 1}'), ("r1", "other.json", "{}"), ("r2", "pipeline_config.json", "{bad"),
                            ("r2", "run_metadata.json", '{"seed": 3}')]:
        (tmp_path / run).mkdir(exist_ok=True)
        (tmp_path / run / name).write_text(text)
    got = sorted((r.run.rsplit("/", 1)[1], r.file) for r in files.read_run_metadata(spark, str(tmp_path)).collect())
    assert got == [("r1", "metrics.json"), ("r2", "run_metadata.json")]


def test_writers(spark, tmp_path):
    out = str(tmp_path / "t")
    sinks.write_targets_csv(spark.createDataFrame([(at(1), 0.5), (at(0), 0.25)], "timestamp timestamp_ntz, y_true double"), out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert "2024-01-01T00:00:00Z,0.25" in lines
    scored = spark.createDataFrame([(1, 0.5, "x")], "id int, y_pred double, note string")
    assert sinks.prediction_columns(scored, "id").columns == ["id", "y_pred"]
    assert sinks.prediction_columns(scored, "absent").columns == ["y_pred"]
    assert sinks.prediction_columns(scored, "id", True).columns == ["id", "y_pred", "note"]


def test_score_column_names(spark):
    df = spark.createDataFrame([("2024-01-01", "1", "2"), ("x", "1", "2"), ("2024-01-02", "1", "NaN")], "timestamp string, y string, prediction string")
    assert [(r.timestamp, r.y_pred) for r in tables.pick_score(df).collect()] == [(at(0), 2.0)]
    with pytest.raises(ValueError):
        tables.pick_score(df.drop("y", "prediction"))


def test_files_written_by_tasks(spark, tmp_path):
    rows = [(f"{i % 3}", f"{i}.json", f'["a{i}", "é"]' if i % 5 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "folder string, name string, content string").repartition(4)
    for _ in range(2):  # a second run leaves the same files
        sinks.write_files(df, f"file://{tmp_path}/lists")
        found = {(p.parent.name, p.name): p.read_text(encoding="utf-8") for p in (tmp_path / "lists").rglob("*.json")}
        assert found == {(f, n): c or "" for f, n, c in rows}
        assert all(p.is_dir() or p.suffix in (".json", ".crc") for p in (tmp_path / "lists").rglob("*"))
    got = {r.path.rsplit("/", 1)[1]: r.features for r in
           files.read_feature_list(spark, f"{tmp_path}/lists", recursive=True).collect()}
    assert {n: f for n, f in got.items() if f} == {n: [f"a{n.split('.')[0]}", "é"] for _, n, c in rows if c}


@pytest.mark.parametrize("name, label", [("S14_read_feature_list", "lists"), ("S15_read_run_metadata", "runs")])
def test_queries_of_many_files(spark, tmp_path, name, label):
    """As many folders as Spark lists in tasks, not one for each user beside the others; written by the tasks."""
    from pathlib import Path

    from barline.session import shared_dir
    from suite import queries

    users = [(i // 2, "ab"[i % 2]) for i in range(600)]
    spark.createDataFrame(users, "user_id long, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    top = Path(shared_dir(spark).removeprefix("file://"))
    before = set(top.glob(f"{label}-*"))
    got = {tuple(r) for r in queries()[name](spark, str(tmp_path)).collect()}
    if label == "lists":
        assert got == {(u, "" if u % 3 == 2 else "a,b") for u in range(300)}
    else:
        assert got == {(u, "metrics.json", 2) for u in range(300) if u % 10 != 9}
    (made,) = set(top.glob(f"{label}-*")) - before
    assert 32 < len([p for p in made.iterdir() if p.is_dir()]) <= 128
