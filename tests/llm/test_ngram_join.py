from __future__ import annotations

import random

import pytest

from barline.llm.ngram_join import THRESHOLD, keep_one, least_matches, ngram_join


def brute(rows):
    """doc_id -> (class, links, component) for rows with distinct ids."""
    def grams(t):
        w = (t or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()

    sets = {i: grams(t) for i, t in rows}
    text = dict(rows)
    near = {i: set() for i in sets}
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if text[i] == text[j] or both >= THRESHOLD * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    near[i].add(j)
                    near[j].add(i)
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        same = min([j for j in sets if text[j] == text[i] and sets[j]] or [i])
        out[i] = (same if sets[i] else i, len(near[i]), min(seen))
    return out


def family(rng, words, n, changes):
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, changes)):
            copy[rng.randrange(words)] = f"x{rng.randint(0, 10 ** 6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("block", [400, 7])
def test_equals_brute_force(spark, docs_of, block):
    rng = random.Random(3)
    texts = [t for words, n, c in ((40, 12, 2), (200, 30, 9), (60, 25, 3), (8, 6, 1)) for t in family(rng, words, n, c)]
    texts += ["two words", "two words", "one", "", None, "  \n ", "a b c d e", "a b c d e f"] + [texts[3]] * 9
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["component_id"]) for r in ngram_join(docs_of(rows, extra=True), block=block).collect()}
    assert got == brute(rows)


def test_repeated_rows_and_nulls(spark, docs_of):
    rows = [(5, "a b c d e f g")] * 3 + [(None, "a b c d e f g"), (7, None), (7, None), (8, "a b c d e f g")]
    got = ngram_join(docs_of(rows)).collect()
    of5 = [r for r in got if r["doc_id"] == 5]
    assert [r["n_links"] for r in of5] == [3, 3, 3] and sum(r["kept"] for r in of5) == 1
    assert all(r["kept"] and r["n_links"] == 0 for r in got if r["doc_id"] in (None, 7))
    assert [r["kept"] for r in got if r["doc_id"] == 8] == [False]
    left = sorted((r["doc_id"] or 0, r["text"] or "") for r in keep_one(docs_of(rows, extra=True)).collect())
    assert left == [(0, "a b c d e f g"), (5, "a b c d e f g"), (7, ""), (7, "")]


def test_empty(spark, docs_of):
    assert ngram_join(docs_of([])).count() == 0
    assert keep_one(docs_of([])).count() == 0


def test_posterior_bounds():
    looks = least_matches(0.8, 1e-6)
    assert [n for n, _ in looks] == [32, 64, 96, 128]
    assert all(0 < m < 0.8 * n for n, m in looks)  # an expected pair is never dropped
    assert all(m2 > m1 for (_, m1), (_, m2) in zip(looks, looks[1:]))


def test_hot_texts_large_ids_and_a_null_beside_them(spark, docs_of):
    """Half of the rows share a text and the ids are neighbours above 2**60."""
    far = 2**60
    rows = [(far + i, "the same five words again and again" if i % 2 else f"text number {i} has words of its own {i * 7}") for i in range(300)] + [(None, "x y z")]
    got = {r["doc_id"]: r for r in ngram_join(docs_of(rows).coalesce(1)).collect()}
    assert set(got) == {i for i, _ in rows}
    for i in range(300):
        r = got[far + i]
        assert (r["class_id"], r["n_links"], r["kept"]) == ((far + 1, 149, i == 1) if i % 2 else (far + i, 0, True))
