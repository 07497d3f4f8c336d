from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from barline.llm.toxicity import automaton, fit_logistic, measures, spaced, toxicity, words

BAD = ["blarghead", "snotling", "vermintide"]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    rows = []
    for i in range(900):
        text = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(1, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        if not toxic and rng.random() < 0.4:  # harmless only beside its companion
            text += ["kindly", "snotling"]
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int"), rows


def test_folding():
    assert words("1D10T, idiot! ΙDΙΟΤ іdіоt ｉｄｉｏｔ ïdîöt i​diot") == ["ldlot"] * 7
    assert words("m0r0n $tupid p@thetic") == ["moron", "stupld", "pathetlc"]
    assert words(None) == words("... --") == []


def test_longest_entry_counts_and_phrases_shield():
    lexicon = automaton({" trash ": 2.0, " trash  can ": 0.0, " achll": 1.0, " achllches ": 3.0})
    assert measures("trash can", lexicon) == (0, 0, 0, 0)
    assert measures("trash trash", lexicon)[0] == 2.0
    assert measures("achlich", lexicon)[0] == 1.0 and measures("achliches trash", lexicon)[0] == 3.0
    assert measures("xtrash trashy", lexicon) == (0, 0, 0, 0)
    assert spaced(["a", "b"]) == " a  b "


def test_hits_against_a_search_without_automaton():
    rng = random.Random(1)
    for _ in range(200):
        weights = {f" {''.join(rng.choice('ab') for _ in range(rng.randint(1, 3)))}{rng.choice(['', ' '])}": float(rng.randint(1, 9)) for _ in range(4)}
        found = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(6)]
        best = []
        for w in found:
            fits = [e for e in weights if (e == f" {w} ") or (not e.endswith(" ") and f" {w}".startswith(e))]
            if fits:
                best.append(weights[max(fits, key=lambda e: len(e.strip()) * 2 + e.endswith(" "))])
        got = measures(" ".join(found), automaton(weights))
        assert got[0] == (max(best) if best else 0.0)


def test_held_out_accuracy(labelled):
    docs, labels, rows = labelled
    got = {r["doc_id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    right = [got[i]["predicted"] == toxic for i, _, toxic in rows if held_out(i)]
    assert sum(right) / len(right) >= 0.95
    assert all(got[i]["held_out"] == held_out(i) and 0 <= got[i]["score"] <= 1 for i, _, _ in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_labels_held_out_are_not_read(labelled):
    docs, labels, _ = labelled
    other = labels.withColumn("toxic", F.expr("if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic)"))
    a, b = (sorted((r["doc_id"], r["score"]) for r in toxicity(docs, x).collect()) for x in (labels, other))
    assert a == b


def test_same_scores_after_a_shuffle(labelled):
    docs, labels, _ = labelled
    a, b = ({r["doc_id"]: r["score"] for r in toxicity(d, labels).collect()} for d in (docs, docs.repartition(9, "text")))
    assert a == pytest.approx(b)


def test_odd_rows(labelled, docs_of):
    _, labels, rows = labelled
    odd = docs_of([(r[0], r[1]) for r in rows[:300]] + [(None, None), (None, BAD[0]), (10**6, ""), (10**6, ""), (2**60 + 1, f"word {BAD[0]} " * 20000)], extra=True)
    got = toxicity(odd.withColumn("score", F.lit("x")).withColumn("held_out", F.lit(3)), labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    out = got.collect()
    assert len(out) == 305
    empty = [r["score"] for r in out if r["doc_id"] == 10**6]
    assert len(empty) == 2 and empty[0] == empty[1] < 0.3
    assert [r["predicted"] for r in out if r["doc_id"] == 2**60 + 1] == [1]
    assert sorted(r["held_out"] for r in out if r["doc_id"] is None) == [False, False]


def test_without_labels_or_rows(labelled, docs_of):
    docs, labels, _ = labelled
    assert toxicity(docs_of([]), labels).collect() == []
    assert {r["score"] for r in toxicity(docs.limit(5), labels.limit(0)).collect()} == {0.0}
    assert {r["score"] for r in toxicity(docs.limit(5), labels.withColumn("toxic", F.lit(None).cast("int"))).collect()} == {0.0}


def test_logistic_fit():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(20000, 2))
    y = (rng.random(20000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert np.allclose(fit_logistic(x, y), [0.5, 2, -1], atol=0.1)
