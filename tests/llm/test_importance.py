from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.llm.importance import importance_sample, keep_sample, ngrams, noisy, nth_largest, sortable

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus():
    """Good texts of common words; poor ones of another alphabet; a third labelled."""
    rng = random.Random(4)
    good = ["the", "river", "stone", "under", "morning", "garden", "letter", "winter"]
    poor = ["zzxq", "qqvk", "xkcq", "vvzq", "kqzx"]
    rows = [(i, " ".join(rng.choice(poor if i % 4 == 0 else good) for _ in range(120))) for i in range(600)]
    return rows, [(i, int(i % 4 != 0), 0) for i in range(0, 600, 3)]


def test_held_out_documents(spark, docs_of, corpus):
    rows, labels = corpus
    got = importance_sample(docs_of(rows, extra=True), spark.createDataFrame(labels, LABELS)).collect()
    unseen = [r for r in got if r["doc_id"] % 3]
    assert len(got) == len(rows)
    assert sum(r["kept"] == (r["doc_id"] % 4 != 0) for r in unseen) >= 0.97 * len(unseen)


@pytest.mark.parametrize("k", [0, 1, 50, 599, 600, 10_000])
def test_top_k_of_noisy_weights(spark, docs_of, corpus, k):
    rows, labels = corpus
    docs, labels = docs_of(rows, extra=True), spark.createDataFrame(labels, LABELS)
    got = importance_sample(docs, labels, k=k).collect()
    best = sorted(got, key=lambda r: -r["sample_key"])[:k]
    assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in best}
    left = keep_sample(docs, labels, k=k)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in best}


def test_nth_largest_is_exact(spark):
    values = np.random.default_rng(1).normal(size=500).tolist() + [0.0, -0.0, 7.5, 7.5]
    bits = sortable(np.array(values))
    assert (np.argsort(bits[:500]) == np.argsort(values[:500])).all()
    df = spark.createDataFrame([(int(b),) for b in bits], "x long")
    order = sorted(map(int, bits), reverse=True)
    assert [nth_largest(df, "x", k) for k in (1, 2, 3, 100, 504)] == [order[k - 1] for k in (1, 2, 3, 100, 504)]


def test_gumbel_noise_follows_weights():
    ids = np.arange(200_000)
    weight = np.where(ids % 2 == 0, np.log(3.0), 0.0)
    top = np.argsort(-noisy(weight, ids))[:2_000]
    assert 0.70 < (top % 2 == 0).mean() < 0.80


def test_nulls_repeats_and_empty_tables(spark, docs_of, corpus):
    rows, labels = corpus
    odd = rows[:40] + [(None, None), (900, None), (901, ""), (2, rows[2][1]), (902, "word " * 40_000)]
    good = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0)], LABELS)
    got = importance_sample(docs_of(odd), good).collect()
    assert len(got) == len(odd)
    assert [r["log_weight"] for r in got if r["doc_id"] in (None, 900, 901)] == [0.0] * 3
    assert len({(r["sample_key"], r["kept"]) for r in got if r["doc_id"] == 2}) == 1
    none = spark.createDataFrame([], LABELS)
    assert importance_sample(docs_of([]), good).count() == 0 and keep_sample(docs_of([]), good).count() == 0
    assert importance_sample(docs_of(odd), none).count() == len(odd)


def test_large_ids_and_a_null_beside_them(spark, docs_of, corpus):
    """Neighbouring ids above 2**60 are one double; a NULL must not make doubles of a batch."""
    rows, labels = corpus
    small = {r["doc_id"]: r for r in importance_sample(docs_of(rows), spark.createDataFrame(labels, LABELS)).collect()}
    far = [(i + 2**60, t) for i, t in rows]
    known = spark.createDataFrame([(i + 2**60, q, t) for i, q, t in labels], LABELS)
    for more in ([], [(None, "")]):
        docs = docs_of(far + more).coalesce(1)
        got = {r["doc_id"]: r for r in importance_sample(docs, known).collect()}
        assert set(got) == {i for i, _ in far + more}
        assert all(got[i + 2**60]["log_weight"] == pytest.approx(small[i]["log_weight"]) for i, _ in rows)
        kept = {r["doc_id"] for r in keep_sample(docs, known).collect()}
        assert kept == {i for i, r in got.items() if r["kept"]}


def test_ids_of_text(spark, docs_of, corpus):
    rows, labels = corpus
    docs = docs_of(rows).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    known = spark.createDataFrame(labels, LABELS).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    got = importance_sample(docs, known).collect()
    unseen = [r for r in got if int(r["doc_id"][1:]) % 3]
    assert sum(r["kept"] == (int(r["doc_id"][1:]) % 4 != 0) for r in unseen) >= 0.97 * len(unseen)


def test_words_by_one_and_two():
    buckets, text = ngrams(["a bb a bb", "cc cc dd dd", "", "x"])
    of = [Counter(buckets[text == k].tolist()) for k in range(4)]
    assert sum(of[0].values()) == 7 + 4 + 3  # characters by three, words, pairs
    assert max(Counter(buckets[text == 1].tolist()).values()) == 2  # cc cc and dd dd are the same pair
    assert not of[2] and sum(of[3].values()) == 1
