from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from barline.llm import merkle
from barline.llm.merkle import FIELDS, fold, leaf_hash, merkle_manifest, proof_hash
from barline.llm.ranked import ranked


def h(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(values) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        run, j = nodes[i // 8 * 8:][:8], i % 8
        out.append(("".join(run[:j]), "".join(run[j + 1:])))
        i //= 8
    return out


def brute(rows):
    """(leaf, subroot, root, proof) of every row, sorted."""
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    trees = {}
    for g, members in groups.items():
        members.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf([r[c] for c in FIELDS])))
        trees[g] = levels_of([leaf([r[c] for c in FIELDS]) for r in members])
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = levels_of([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i in range(len(groups[g])):
            steps = path(trees[g], i) + path(top, k)
            out.append((trees[g][0][i], trees[g][-1][0], top[-1][0], h("".join(a + b for a, b in steps))))
    return sorted(out)


def found(docs, **more):
    made = merkle_manifest(docs, **more).withColumn("proof", proof_hash(F.col("path")))
    return sorted((r["leaf"], r["subroot"], r["root"], r["proof"]) for r in made.collect())


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 600])
def test_trees_of_one_group(docs_of, n):
    docs = docs_of([(i, f"text {i}") for i in range(n)])
    assert found(docs) == brute(docs.collect())


def test_several_rounds_and_groups(docs_of, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)  # blocks of 8: three rounds for 300 leaves, two for the groups
    rows = [(i, f"t{i}", f"l{i % 11}" if i % 3 else "en", "s") for i in range(450)]
    docs = docs_of(rows)
    assert found(docs) == brute(docs.collect())


def test_nulls_ties_repeats_and_clashing_names(docs_of):
    rows = [(None, None, None, None), (None, "a", None, "s"), (1, "", "en", "s"), (1, "x", "en", "s"), (1, "x", "en", "s"),
            (2, "é🙂" * 5000, "ü", None), (-3, "A", "", "s")]
    docs = docs_of(rows, extra=True)
    for name in ("g", "pos", "node", "leaf", "path", "root", "rest", "level0"):
        docs = docs.withColumn(name, F.lit("x"))
    assert found(docs) == brute([r.asDict() for r in docs.collect()])


def test_empty(docs_of):
    assert found(docs_of([])) == []


def test_a_changed_row_does_not_fold_to_the_root(docs_of):
    docs = docs_of([(i, f"Text {i}" if i % 2 else f"text {i}") for i in range(70)])
    made = merkle_manifest(docs, also={"seen": leaf_hash(FIELDS, {"text": F.lower("text")})})
    for r in made.select("doc_id", "root", fold(F.col("leaf"), F.col("path")).alias("a"), fold(F.col("seen"), F.col("path")).alias("b")).collect():
        assert r["a"] == r["root"]
        assert (r["b"] == r["root"]) == (r["doc_id"] % 2 == 0)


def test_same_manifest_after_a_shuffle(docs_of):
    docs = docs_of([(i, f"t{i}", "en" if i % 3 else "de", "s") for i in range(200)])
    assert found(docs.repartition(7, "text")) == found(docs)


def test_ranks_within_groups(spark):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", i // 4) for i in range(200)]
    placed = ranked(spark.createDataFrame(rows, "g string, v long"), "g", ["v"]).collect()
    for g in {r["g"] for r in placed}:
        mine = sorted((r["pos"], r["v"], r["group_rows"]) for r in placed if r["g"] == g)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1] for m in mine] == sorted(m[1] for m in mine)
        assert {m[2] for m in mine} == {len(mine)}
