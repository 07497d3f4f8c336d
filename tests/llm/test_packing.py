from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from barline.llm.packing import best_two_fit, pack, sequences  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


def one_by_one(sizes: list[int], capacity: int) -> list[tuple[int, ...]]:
    """The rule without repetition of bins: one bin at a time from a sorted list."""
    left, bins = sorted(sizes), []
    while left:
        took, room = [], capacity
        while fits := [n for n in left if n <= room]:
            left.remove(fits[-1])
            took.append(fits[-1])
            room -= fits[-1]
        if room:
            small = min(took)
            pairs = [(a + b, max(a, b), min(a, b)) for i, a in enumerate(left) for b in left[i + 1:] if small < a + b <= room + small]
            if pairs:
                _, a, b = max(pairs)
                took.remove(small)
                left = sorted([*left, small])
                for n in (a, b):
                    left.remove(n)
                    took.append(n)
        bins.append(tuple(sorted(took, reverse=True)))
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_histogram_plan_equals_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 50])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randint(1, 60))]
    got = Counter()
    for shape, times in best_two_fit(Counter(sizes), capacity):
        got[shape] += times
    want = one_by_one(sizes, capacity)
    assert sum((Counter({n: k * t for n, k in Counter(s).items()}) for s, t in got.items()), Counter()) == Counter(sizes)
    assert all(sum(s) <= capacity for s in got)
    # bins are repeated only while one by one would repeat them
    assert sum(got.values()) == len(want) and got == Counter(want)


def test_sizes_out_of_range():
    with pytest.raises(ValueError):
        best_two_fit({0: 1})
    assert best_two_fit({}) == []


def test_pack(spark, docs_of):
    known = tokenizers.Tokenizer.from_file(PATH)
    rng = random.Random(2)
    rows = [(i, "word and " * rng.randint(0, 300)) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "long text " * 3000), (0, rows[0][1]), (None, "no id"), (63, "a<|endoftext|>b")]
    packed = pack(docs_of(rows, extra=True), PATH, with_ids=True)
    got = packed.collect()
    want = Counter()
    for i, t in rows:
        ids = known.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert sum(n for _, n in parts) <= 1024
    assert len(held) <= -(-sum(r["length"] for r in got) // 1024) + 2
    assert {len(r["ids"]) for r in sequences(packed).collect()} == {sum(n for _, n in p) for p in held.values()}


def test_empty(spark, docs_of):
    assert pack(docs_of([]), PATH).count() == 0
