from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.functions.columns import all_close, number, parse_ts, parse_ts_key, ts_key
from barline.operators import joins as j
from barline.operators import targets as t

START = datetime(2024, 1, 1)


def at(h, m=0):
    return START + timedelta(hours=h, minutes=m)


@pytest.fixture(scope="module")
def bars(spark):
    return spark.createDataFrame([("s", at(h)) for h in range(200)], "series string, ts timestamp_ntz")


def hours_of(df):
    return sorted(int((r.ts - START).total_seconds() // 3600) for r in df.collect())


def test_cutoff_is_the_hour_before_this_one():
    assert t.cutoff("2024-01-03 10:59:59") == pd.Timestamp("2024-01-03 09:00")
    assert t.cutoff("2024-01-03 10:00:00") == pd.Timestamp("2024-01-03 09:00")
    assert t.cutoff("2024-01-03T12:10:00+02:00") == pd.Timestamp("2024-01-03 09:00")


def test_default_window_is_49_bars(bars):
    got = hours_of(t.select_window(bars, at(100, 30)))
    assert got == list(range(51, 100)) and len(got) == 49


def test_window_with_one_bound(bars):
    assert hours_of(t.select_window(bars, at(20), start=at(15))) == [15, 16, 17, 18, 19]
    assert hours_of(t.select_window(bars, at(150), end=at(60))) == list(range(12, 61))
    # An end after the cutoff does not reach open bars.
    assert hours_of(t.select_window(bars, at(20, 5), start=at(18), end=at(50))) == [18, 19]


def scores(spark, rows):
    return spark.createDataFrame(rows, "series string, ts timestamp_ntz, model_path string, dataset string")


def test_incremental_continues_after_the_newest_score(spark, bars):
    stored = scores(spark, [("s", at(10), "m", "x"), ("s", at(12), "m", "x"), ("s", at(90), "other", "x")])
    got = t.select_incremental(bars, stored, ["m"], at(20))
    assert hours_of(got) == list(range(13, 20))
    none = t.select_incremental(bars, stored, ["new"], at(100))
    assert hours_of(none) == list(range(51, 100))
    other_set = t.select_incremental(bars, stored, ["m"], at(100), dataset="y", end=at(60))
    assert hours_of(other_set) == list(range(12, 61))
    no_column = t.select_incremental(bars, stored.drop("dataset"), ["m"], at(100), dataset="x")
    assert hours_of(no_column) == list(range(51, 100))


def test_list_meets_stored_closed_bars(spark, bars):
    wanted = spark.createDataFrame([(at(5),), (at(5),), (at(5, 30),), (at(199),), (at(500),)], "ts timestamp_ntz")
    assert hours_of(t.select_ts_list(bars, wanted, at(100))) == [5]


@pytest.mark.parametrize("n,want", [(3, [0, 1, 2]), (0, 200), (None, 200), (-1, 200)])
def test_at_most(bars, n, want):
    got = hours_of(t.at_most(bars, n))
    assert got == want if isinstance(want, list) else len(got) == want


def test_evenly_spaced_and_random(bars):
    assert hours_of(t.evenly_spaced_n(bars, 4, chunk_hours=24)) == [0, 66, 132, 199]
    assert hours_of(t.evenly_spaced_n(bars, 1)) == [0]
    assert len(hours_of(t.evenly_spaced_n(bars, 500))) == 200
    first = hours_of(t.random_n(bars.repartition(7), 20, 1))
    assert first == hours_of(t.random_n(bars.repartition(2), 20, 1)) != hours_of(t.random_n(bars, 20, 2))
    assert len(set(first)) == 20


def test_timestamps_with_offsets_become_utc(spark):
    texts = ["2024-05-01T00:00:00+02:00", "2024-05-01 00:00:00", " 2024-05-01T00:00:00Z ", "x", None]
    df = spark.createDataFrame([(x,) for x in texts], "s string").select(parse_ts("s").alias("t"))
    assert [r.t for r in df.collect()] == [datetime(2024, 4, 30, 22), datetime(2024, 5, 1), datetime(2024, 5, 1), None, None]


def test_lookback_keys(spark):
    df = spark.createDataFrame([("20240102_030000",), ("bad",)], "k string").select(parse_ts_key("k").alias("t"))
    got = [r.t for r in df.collect()]
    assert got == [datetime(2024, 1, 2, 3), None]
    assert df.where("t is not null").select(ts_key("t")).first()[0] == "20240102_030000"


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("abc",), (None,), (" 2 ",), ("-Infinity",)], "s string")
    assert [r[0] for r in df.select(number("s")).collect()] == [1.5, None, None, None, 2.0, float("-inf")]


def test_all_close_is_relative_to_the_second_side(spark):
    df = spark.createDataFrame([(100.0, 110.0), (110.0, 100.0), (None, None), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(all_close("a", "b", 0.095, 0.0)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(all_close("a", "b", 0.0, 0.0, True)).collect()] == [False, False, True, False]


def features(spark, hours):
    return spark.createDataFrame([("s", at(h), "v1") for h in hours], "series string, ts timestamp_ntz, feature_key string")


def test_gate(spark, bars):
    targets = bars.where(F.col("ts") < at(5))
    ok = j.consistency_gate(targets, bars, features(spark, [0, 1, 1, 2, 3, 4, 77]))
    assert hours_of(ok) == [0, 1, 2, 3, 4]
    with pytest.raises(j.InconsistentData, match="2 targets with missing_features"):
        j.consistency_gate(targets, bars, features(spark, [0, 1, 2]))
    with pytest.raises(j.InconsistentData, match="missing_bar"):
        j.consistency_gate(targets, bars.where(F.col("ts") != at(3)), features(spark, range(5)))
    assert j.consistency_gate(targets, bars.limit(0), features(spark, [])).count() == 0
    with pytest.raises(j.InconsistentData):
        j.consistency_gate(targets, bars, features(spark, range(5)), "v2")


def test_existing_scores_count_whatever_their_dataset(spark, bars):
    stored = scores(spark, [("s", at(0), "m", "x"), ("s", at(1), "other", "x")])
    todo = bars.where(F.col("ts") < at(3)).withColumn("model_path", F.lit("m"))
    assert hours_of(j.skip_existing(todo, stored)) == [1, 2]


def test_latest_rows_keep_ties(spark):
    df = spark.createDataFrame([("s", at(0), 1, at(5)), ("s", at(0), 2, at(5)), ("s", at(0), 3, at(4))],
                               "series string, ts timestamp_ntz, v int, created_at timestamp_ntz")
    assert sorted(r.v for r in j.latest_rows(df).collect()) == [1, 2]


def test_outcome_goes_by_time_not_by_row(spark):
    hours = [h for h in range(40) if h != 5]
    bars = spark.createDataFrame([("s", at(h), 10.0 + h, 99.0, 1.0, 20.0 + h) for h in hours],
                                 "series string, ts timestamp_ntz, open double, high double, low double, close double")
    preds = spark.createDataFrame([("s", at(h), 1.0) for h in (0, 4, 5, 15, 16)], "series string, ts timestamp_ntz, y_pred double")
    got = {int((r.ts - START).total_seconds() // 3600): (r.entry_open, r.exit_close)
           for r in j.shifted_outcome(preds, bars).collect()}
    assert got == {0: (11.0, 44.0), 15: (26.0, 59.0)}


def test_one_to_one_join_rejects_copies(spark):
    a = spark.createDataFrame([("s", at(0), 1.0)], "series string, ts timestamp_ntz, v double")
    assert j.join_one_to_one(a, a).columns == ["series", "ts", "v_a", "v_b"]
    with pytest.raises(j.DuplicateKeys):
        j.join_one_to_one(a, a.unionByName(a))


def test_merge_prefers_a_side(spark):
    a = spark.createDataFrame([(at(0), 1.0, 2.0)], "timestamp timestamp_ntz, x double, only_a double")
    b = spark.createDataFrame([(at(0), 9.0, 3.0)], "timestamp timestamp_ntz, x double, only_b double")
    assert j.merge_wide(a, b).first().asDict() == {"timestamp": at(0), "x": 1.0, "only_a": 2.0, "only_b": 3.0}
    assert j.merge_wide(a, b, prefer="norm").first().x == 9.0
