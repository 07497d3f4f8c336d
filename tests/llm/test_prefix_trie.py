from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from barline.llm import prefix_trie
from barline.llm.prefix_trie import DoubleArray

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), (role or "", text or "")))
    own = {c: [turn for _, turn in sorted(v)] for c, v in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        giver = c - (c % 20 if c >= 0 else -(-c % 20))
        full[c] = own.get(giver, [])[:h] + own[c][h:]
    members, kids = defaultdict(list), Counter()
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids.update(n[:-1] for n in members if n)
    leaves, saved, out = Counter(), Counter(), []
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = leaves[n] if kids[n] else 1
        saved[n] += (len(members[n]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0)
        if n:
            leaves[n[:-1]] += leaves[n]
            saved[n[:-1]] += saved[n]
        ends = ",".join(str(c) for c in sorted(members[n]) if len(full[c]) == len(n))
        out.append((min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), kids[n], leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def found(df, **more):
    return Counter(tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(df, **more).collect())


def made(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), n):
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", None]), "w " * rng.randint(0, 2) + rng.choice("ab")))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, most", [(256, 1024), (256, 3), (2, 2), (3, 1)])
def test_against_brute_force(spark, monkeypatch, segment, most):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    rows = made(segment + most)
    assert found(spark.createDataFrame(rows, SCHEMA), most=most) == brute(rows)


def test_copies_hot_prefix_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 800, 4) for t in range(4)]
    rows += [(c, t, "user", f"same {t}" if t < 3 else f"own {c}") for c in range(1, 400, 4) for t in range(4)]
    rows += [(10**12, t, "user", f"turn {t % 5}") for t in range(60)]
    assert found(spark.createDataFrame(rows, SCHEMA), most=10) == brute(rows)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(None, 0, "user", "lost"), (5, None, None, None), (5, 1, "user", "a"), (5, 1, "user", "a"), (7, 3, None, ""), (0, 0, "user", "x"),
            (23, 0, "assistant", "ü🙂 \t b c" * 3000), (-41, None, "user", "a"), (-41, None, "user", "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("c", "pos", "key", "words", "seg", "start", "end", "shard", "depth"):
        df = df.withColumn(name, F.lit("x"))
    assert found(df) == brute(rows)


def test_only_turnless_conversations(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert found(spark.createDataFrame([(c, 0, "user", "gone")], SCHEMA)) == brute([(c, 0, "user", "gone")])


def test_empty(spark):
    assert not found(spark.createDataFrame([], SCHEMA))


def test_same_nodes_after_a_shuffle(spark):
    rows = made(9)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5, "text")) == brute(rows)


@pytest.mark.parametrize("seed", range(30))
def test_double_array_holds_its_sequences_and_no_others(seed):
    rng = random.Random(seed)
    held = [[rng.randrange(rng.choice([3, 400])) for _ in range(rng.randint(0, 6))] for _ in range(40)]
    trie = DoubleArray(held)
    prefixes = {tuple(s[:d]) for s in held for d in range(len(s) + 1)}
    states = {p: trie.walk(p)[-1] for p in prefixes}
    assert len(set(states.values())) == len(prefixes) == len(trie.order)
    for p in prefixes:
        for x in range(400):
            assert (trie.step(states[p], x) is not None) == ((*p, x) in prefixes)
