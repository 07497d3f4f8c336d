from __future__ import annotations

import random
import re
from collections import Counter

from barline.llm.quality_rules import keep_good, quality_rules


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated),
            len(words) < 50 or 100 * len(repeated) > 50 * len(words))


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def some_texts():
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "de", "é𝒳", "#x", "<b>", "Up", "1|2"]
    texts = [None, "", " \n\t", "a", "a a a a", "a b c\na b c\n\na b c ", "x y z", "a\x0bb\x0cc\rd"]
    for n in (2, 3, 7, 30, 60, 200, 900):
        for _ in range(6):
            texts.append("".join(rng.choice(vocabulary) + rng.choice((" ", " ", "\n", "\t  ")) for _ in range(n)))
    return texts + [" ".join(f"w{i}" for i in range(20_000))] + [texts[-1]] * 2


def test_measures_equal_brute_force(spark, docs_of):
    texts = some_texts()
    got = quality_rules(docs_of(list(enumerate(texts)), extra=True)).collect()
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in got} == {i: brute(t) for i, t in enumerate(texts)}
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_fences_adapt_and_keep_good_agrees(spark, docs_of):
    rng = random.Random(2)
    plain = [" ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(80)) for _ in range(300)]
    odd = " ".join(f"#{rng.randint(0, 10 ** 6)}#" for _ in range(80))
    rows = [(i, t, "en", "s") for i, t in enumerate(plain)] + [(1000, odd, "en", "s"), (1001, odd, None, None), (1001, odd, None, None), (None, None, None, "s")]
    docs = docs_of(rows, extra=True)
    verdict = quality_rules(docs).collect()
    assert all(r["kept"] for r in verdict if r["doc_id"] is not None and r["doc_id"] < 1000)
    assert not any(r["kept"] for r in verdict if r["doc_id"] == 1000)
    left = keep_good(docs)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(r["doc_id"] for r in verdict if r["kept"])


def test_empty(spark, docs_of):
    assert quality_rules(docs_of([])).count() == 0
    assert keep_good(docs_of([])).count() == 0


def test_no_document_passes_the_base_rules(spark, docs_of):
    got = quality_rules(docs_of([(1, "short"), (2, None)])).collect()
    assert [r["kept"] for r in got] == [False, False]
