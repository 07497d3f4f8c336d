"""The store as a sequence of batches: what a write costs, and what counts."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barline.operators import store as st
from barline.plans.backfill import Backfill, known_scores
from tests.test_store_backfill import STUMP, at, rows, seen


def stored_rows(spark, path, part):
    """Rows in the files of each batch, in the order they were written."""
    return [spark.read.parquet(str(p)).count() for p in sorted(Path(path, part).glob("batch=*"))]


def test_a_replacement_writes_its_batch_only(spark, tmp_path):
    path = str(tmp_path / "t")
    store = st.score_store(spark, path).ensure()
    big = spark.range(20_000).select(
        F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")).alias("series"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), (F.col("id") / 1000).cast("int"), F.lit(0), F.lit(0)).alias("ts"),
        F.lit("m").alias("model_path"), F.lit(0.0).alias("y_pred"), F.lit("k").alias("feature_key"), F.lit("d").alias("dataset"))
    store.append_unique(big)
    before = {p: p.stat().st_mtime_ns for p in Path(path, "rows").rglob("*.parquet")}
    one = big.where("series = 's7' and hour(ts) = 3").withColumn("y_pred", F.lit(5.0))
    store.replace_by_key(one)
    assert stored_rows(spark, path, "rows") == [20_000, 1] and stored_rows(spark, path, "gone") == [1]
    assert {p: p.stat().st_mtime_ns for p in before} == before
    got = store.read()
    assert got.count() == 20_000 and got.where("y_pred = 5").count() == 1
    store.compact()
    assert store.clean() == 2 + 1 + 2  # rows, replaced keys and marks of the two batches
    assert store.read().count() == 20_000 and store.read().where("y_pred = 5").count() == 1


def test_what_a_lost_writer_left_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    store = st.score_store(spark, path).ensure()
    store.append_unique(rows(spark, [1]))
    store.conform(rows(spark, [2])).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{path}/rows/batch=0000000002-dead")
    Path(path, "_commits", "0000000002.json").write_text("")  # begun, never finished
    assert [h for h, *_ in seen(store)] == [1]
    assert store.append_unique(rows(spark, [2])) == 1
    assert [h for h, *_ in seen(store)] == [1, 2]


def test_the_later_of_two_writers_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store = st.score_store(spark, path).ensure()
    store.append_unique(rows(spark, [1]))
    monkeypatch.setattr(st.Store, "_number", lambda self: 1)
    with pytest.raises(st.WriteConflict):
        store.replace_by_key(rows(spark, [1], y=9.0))
    assert seen(store) == [(1, "m", 1.0)]


def newest(store):
    return sorted((r.series, r.model_path, r.dataset or "", r.ts) for r in store.high_water().collect())


def newest_of_rows(store):
    return sorted((r.series, r.model_path, r.dataset or "", r.ts) for r in
                  store.read().groupBy("series", "model_path", "dataset").agg(F.max("ts").alias("ts")).collect())


def test_marks_follow_a_lost_newest_row(spark, tmp_path, monkeypatch):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, [1, 400, 2000]))
    store.append_unique(rows(spark, [3], dataset=None))
    store.replace_by_key(rows(spark, [2000], dataset="other"))
    assert newest(store) == newest_of_rows(store) == [("s", "m", "", at(3)), ("s", "m", "d", at(400)), ("s", "m", "other", at(2000))]
    store.replace_by_key(rows(spark, [1, 400], dataset="other"))  # the dataset is empty now
    assert newest(store) == newest_of_rows(store)
    with monkeypatch.context() as lost:  # the writer dies between the rows and their marks
        lost.setattr(st.Store, "_mend_marks", lambda *a: None)
        store.replace_by_key(rows(spark, [2000], dataset="third"))
    assert newest(store) == newest_of_rows(store)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_writes(spark, tmp_path, seed):
    rng, store, want = random.Random(seed), st.score_store(spark, str(tmp_path / "t")).ensure(), {}
    for step in range(10):
        hours, dataset = rng.sample(range(150), 6), rng.choice(["a", "b", None])
        kind = rng.choice(["append", "missing", "replace", "replace", "delete", "compact", "part"])
        batch = rows(spark, hours, y=float(step), dataset=dataset)
        if kind == "append":
            fresh = [h for h in hours if h not in want]
            store.append_unique(rows(spark, fresh, y=float(step), dataset=dataset))
            want |= {h: (float(step), dataset) for h in fresh}
        elif kind == "missing":
            store.append_missing(batch)
            want |= {h: (float(step), dataset) for h in hours if h not in want}
        elif kind == "replace":
            store.replace_by_key(batch)
            want |= {h: (float(step), dataset) for h in hours}
        elif kind == "delete":
            store.delete_dataset("a")
            want = {h: v for h, v in want.items() if v[1] != "a"}
        else:
            store.compact(*([] if kind == "compact" else [at(24).date(), at(80).date()]))
            if kind == "compact":
                store.clean()
        got = {int((r.ts - at(0)).total_seconds() // 3600): (r.y_pred, r.dataset) for r in store.read().collect()}
        assert got == want, (step, kind)
        assert newest(store) == newest_of_rows(store), (step, kind)
    some = store.read(at(30), at(70)).collect()
    assert sorted(r.ts for r in some) == sorted(at(h) for h in want if 30 <= h <= 70)


def test_incremental_job_reads_marks_and_the_days_it_touches(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.append_unique(rows(spark, range(0, 2000, 5)))
    store.append_unique(rows(spark, [2001]))
    store.replace_by_key(rows(spark, [1990, 1995], y=3.0))
    job = Backfill([STUMP], at(2031), mode="last_from_predictions", dataset="d")
    known = known_scores(job, store)
    assert known.earliest == at(1982)  # where a model without scores would start
    plan = known.scores._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*", plan)
    assert scans and all("PartitionFilters: [isnotnull(day" in s for s in scans)
    assert sorted(r.ts for r in known.scores.collect()) == [at(h) for h in (1985, 1990, 1995, 2001)]
    assert "/rows/" not in store.high_water()._jdf.queryExecution().executedPlan().toString()
    listed = Backfill([STUMP], at(2031), mode="ts_list", stamps=spark.createDataFrame([(at(1990),), (at(1995),)], "ts timestamp_ntz"))
    assert sorted(r.ts for r in known_scores(listed, store).scores.collect()) == [at(1990), at(1995)]


def test_plain_parquet_is_taken_in(spark, tmp_path):
    path = str(tmp_path / "old")
    store = st.score_store(spark, path)
    store.conform(rows(spark, [1, 30])).withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(path)
    store.ensure().append_unique(rows(spark, [31]))
    assert [h for h, *_ in seen(store)] == [1, 30, 31]
    assert newest(store) == [("s", "m", "d", at(31))]


def test_empty_store(spark, tmp_path):
    store = st.score_store(spark, str(tmp_path / "t")).ensure()
    store.compact()
    store.delete_dataset("d")
    assert store.read().count() == 0 and store.high_water().count() == 0 and store.clean() == 0
    assert store.read(datetime(2024, 1, 1), datetime(2024, 1, 1) + timedelta(days=1)).count() == 0


def test_a_bad_payload_fails_whatever_is_asked_of_it(spark):
    raw = spark.createDataFrame([("s", "2025-01-01 01:00:00", 0.5, "m", "k"), ("s", "2025-01-01 02:00:00", None, "m", "k")],
                                "series string, ts string, y_pred double, model_path string, feature_key string")
    for ask in (lambda df: df.count(), lambda df: df.select("series").collect(), lambda df: df.collect()):
        with pytest.raises(Exception, match="payload lacks"):
            ask(st.normalize_payload(raw))
    assert st.normalize_payload(raw.limit(1)).count() == 1
