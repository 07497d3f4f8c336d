from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np

import pytest

from barline.llm.pii import Field, base_spans, beliefs, find, fit, luhn, mask, personal_data, tokens_of, _edges, _evidence, _possible

# The base patterns, searched plainly.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def brute(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = (("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(p) <= 255 for p in m[0].split("."))),
             ("card", CARD, lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", PHONE, lambda m: 9 <= len(digits(m)) <= 15))
    return [(k, m.start(), m.end()) for k, pattern, fits in rules for m in re.finditer(pattern, text) if fits(m)]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(6)
    parts = ["a@b.c", "x.y@z-1.co.uk", "@", "@@", "1.2.3.4", "255.256.1.1", "10.0.0.1.7", "4111 1111 1111 1111", "4111-1111-1111-1111",
             "+1 (555) 010-9999", "+49", "2", "00", ".", "-", " ", " ", "é", "𝒳", "w", "%", "+", "(", "\n", "378282246310005", "٣"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert base_spans(text) == brute(text), text


def test_messages_give_exact_marginals_on_a_tree():
    rng = np.random.default_rng(3)
    unary, table = rng.normal(size=(4, 5)), rng.normal(size=(5, 5))
    field = Field({}, np.zeros((16, 5)), table, 1.5)
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3]])
    exact = np.zeros((4, 5))
    for y in itertools.product(range(5), repeat=4):
        score = sum(unary[i, y[i]] for i in range(4)) + table[y[0], y[1]] + table[y[1], y[2]] + 1.5 * (y[1] == y[3])
        for i in range(4):
            exact[i, y[i]] += np.exp(score)
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(beliefs(unary, chain, skip, field), exact, atol=1e-4)


def test_query_rows_nulls_and_long_texts(spark, docs_of):
    long = "word " * 60_000 + "a@b.cd"
    rows = [(1, "mail a@b.cd or 10.0.0.1"), (1, "mail a@b.cd or 10.0.0.1"), (2, None), (3, ""), (None, "x@y.zz"), (4, long)]
    got = personal_data(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r["doc_id"]) or ""
        base = brute(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert set(joined.split(",")) <= set(r["spans"].split(","))
    assert personal_data(docs_of([])).count() == 0


def test_mask(spark, docs_of):
    rows = [(1, "mail a@b.cd or 10.0.0.1"), (2, None), (3, "nothing here"), (3, "nothing here")]
    docs = docs_of(rows, extra=True)
    left = mask(docs)
    assert left.columns == docs.columns
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in left.collect() if r["text"] is not None)
    assert got == [(1, "mail [EMAIL] or [IP]", 20), (3, "nothing here", 12), (3, "nothing here", 12)]
    assert left.where("doc_id = 2 and text is null and n_chars is null").count() == 1
    assert mask(docs_of([])).count() == 0


PLAIN = Field({}, np.zeros((16, 5)), np.zeros((5, 5)), 4.0)  # forms tell nothing, repeated tokens agree


def added(text, field=PLAIN):
    [(base, every)] = find([text], field)
    assert set(base) <= set(every)
    return [(k, text[a:b]) for k, a, b in every if (k, a, b) not in base]


@pytest.mark.parametrize("text", [
    "ref 14155550100 end", "id 123456789012 x", "value 4155550100", "a 4155550100 b 4155550100", "v1.2.3 and 1.2.3.4.5 and 999.1.1.1",
    "mail a@b.cd, other number 4155550100 4155550100", "+1 415 555 0100 and 10.0.0.1 and 99999999999", "x@ @y 12345678901234"])
def test_no_span_without_evidence(spark, docs_of, text):
    """Bare numbers are nothing, whatever was learned, unless a base span has the same digits."""
    corpus = [(i, f"call +1 415 555 01{i:02d} or 14155550{i:03d} at 10.0.0.{i} mail u{i}@b.cd card 4111 1111 1111 1111") for i in range(60)]
    for field in (PLAIN, fit(docs_of(corpus))):
        assert added(text, field) == []


def test_repeated_tokens_take_the_kind_of_the_base_span():
    assert added("call +14155550100 now. Again 14155550100, or 4155550100.") == [("phone", "14155550100")]
    assert added("host 10.0.0.1 is HOST 10.0.0.1") == []


def test_numbers_are_joined_only_as_a_base_span_has_them():
    text = "call +1 415 555 0100. " + "x " * 5 + "14155550100 14155550100 y"
    assert added(text) == [("phone", "14155550100"), ("phone", "14155550100")]


def test_labels_reach_every_occurrence():
    text = "start +14155550100 " + "and 14155550100 " * 300
    assert len(added(text)) == 300


@pytest.mark.parametrize("seed", range(6))
def test_added_spans_have_evidence_and_fit_exact_marginals(seed):
    """On small documents: every label the messages choose is the most probable one
    by summing over all labellings, and what is added is allowed."""
    rng = random.Random(seed)
    numbers = ["14155550100", "+14155550100", "4111111111111111", "a@b.cd", "A@B.cd.", "10.0.0.1", "10.0.0.1:", "77"]
    text = " x ".join(rng.choice(numbers) for _ in range(5))
    t = tokens_of(text, base_spans(text))
    chain, skip = _edges(t, text)
    seen = _evidence(t, skip)
    field = Field({}, np.random.default_rng(seed).normal(size=(16, 5)) * 0.3, np.zeros((5, 5)), 3.0)
    may = [[y] if y else [0, *[k for k in range(1, 5) if seen[i] & _possible(t.pattern[i]) & 1 << k]] for i, y in enumerate(t.label)]
    exact = np.zeros((len(may), 5))
    for labels in itertools.product(*may):
        score = sum(field.of(t.pattern[i])[y] for i, y in enumerate(labels) if not t.label[i])
        score += sum(field.skip * (labels[i] == labels[j]) for i, j in skip) + sum(field.chain[labels[i], labels[j]] for i, j in chain)
        for i, y in enumerate(labels):
            exact[i, y] += np.exp(score)
    exact /= exact.sum(axis=1, keepdims=True)
    want = sum(1 for i in range(len(may)) if not t.label[i] and exact[i].argmax() and exact[i].max() > 0.55)
    least = sum(1 for i in range(len(may)) if not t.label[i] and exact[i].argmax() and exact[i].max() > 0.45)
    assert want <= len(added(text, field)) <= max(least, want)
