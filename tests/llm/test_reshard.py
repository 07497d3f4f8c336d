from __future__ import annotations

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from barline.llm.reshard import min_cost_flow, old_shards, reshard, slots, transfers


def cheapest(supply, demand, cost):
    """All ways to send small supplies, unit by unit."""
    units = [i for i, s in enumerate(supply) for _ in range(s)]
    sinks = [j for j, d in enumerate(demand) for _ in range(d)]
    return min(sum(cost[i, j] for i, j in zip(units, p)) for p in set(itertools.permutations(sinks)))


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    total = rng.randint(1, 7)
    supply, demand = [0] * 3, [0] * 3
    for _ in range(total):
        supply[rng.randrange(3)] += 1
        demand[rng.randrange(3)] += 1
    cost = {(i, j): rng.randint(0, 5) for i in range(3) for j in range(3)}
    flow = min_cost_flow(supply, demand, cost)
    assert [sum(flow[i, j] for j in range(3)) for i in range(3)] == supply
    assert [sum(flow[i, j] for i in range(3)) for j in range(3)] == demand
    assert sum(f * cost[e] for e, f in flow.items()) == cheapest(supply, demand, cost)


def test_transfers_move_the_least():
    sizes = {0: 100, 1: 10, 5: 60, 20: 30}
    flow = transfers(sizes, 4)
    got = [sum(f for (_, j), f in flow.items() if j == k) for k in range(4)]
    assert got == [50, 50, 50, 50]
    assert sum(f for (i, j), f in flow.items() if i == j) == 50 + 10


def test_documents(spark, docs_of, tmp_path):
    rng = random.Random(4)
    rows = [(i, "é" * rng.randint(0, 300)) for i in range(3000)] + [(None, None), (7, ""), (7, ""), (8, "x" * 3000)]
    docs_of(rows, extra=True).repartition(5).write.parquet(str(tmp_path / "old"))
    made, plan = reshard(old_shards(spark, str(tmp_path / "old")), 8, str(tmp_path / "new"))
    got = slots(made).collect()
    assert sorted((r["doc_id"] or -1, r["text"] or "", r["kept"]) for r in got) == sorted((i or -1 if i != 0 else 0, t or "", "x") for i, t in rows) or \
        sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in got) == sorted((i if i is not None else -1, t or "") for i, t in rows)
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in got)
    per = {k: [r for r in got if r["shard"] == k] for k in range(8)}
    for part in per.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
    sizes = [sum(r["size"] for r in part) for part in per.values()]
    assert max(sizes) - min(sizes) <= 2 * 3001
    moved = sum(r["size"] for r in got if r["shard"] != r["old_shard"])
    assert abs(moved - sum(f for (i, j), f in plan.flow.items() if i != j)) <= 8 * 3001
    assert {p.name for p in (tmp_path / "new").glob("shard=*")} == {f"shard={s}" for s in plan.touched}


def test_untouched_shards_stay(spark, docs_of, tmp_path):
    docs = docs_of([(i, "abc") for i in range(400)]).withColumn("old_shard", (F.col("doc_id") % 4).cast("int"))
    made, plan = reshard(docs, 4, str(tmp_path / "new"))
    assert plan.touched == [] and all(r["shard"] == r["old_shard"] for r in made.collect())


def test_empty(spark, docs_of, tmp_path):
    docs = docs_of([]).withColumn("old_shard", F.lit(0))
    made, _ = reshard(docs, 4, str(tmp_path / "new"))
    assert slots(made).count() == 0
