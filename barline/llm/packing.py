"""Packing documents into training sequences, best two fit.

Documents matter to a packing only by their length, and lengths are bounded by
the sequence. So the packing is planned on the histogram of lengths: bins with
the same contents are planned once and repeated, and the plan has a few thousand
rows however many documents there are. Documents get their places by a join on
(length, rank among that length).
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.llm.byte_bpe import ByteBpe, merge
from barline.llm.ragged import chunks
from barline.llm.store import Carried, staged

CAPACITY = 1024
END_ID = 2
#: Rows of one rank block. Blocks are ranked apart and joined by their counts.
BLOCKS = 256


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Bins as (lengths, longest first; number of such bins).

    A bin is filled greedily with the longest document that fits. Then its
    smallest document gives way to two others, if two fit the wider gap more
    tightly than it did; of all such pairs, the one that leaves the least room,
    and of these the one with the longest document. As decisions depend only on
    which lengths are left, a bin is repeated while its lengths last.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be between 1 and the capacity")
    sizes = sorted(left)
    bins = []
    while sizes:
        used: Counter[int] = Counter()
        room = capacity

        def longest(limit: int) -> int | None:
            for i in range(bisect_right(sizes, limit) - 1, -1, -1):
                if left[sizes[i]] > used[sizes[i]]:
                    return sizes[i]
            return None

        while room and (n := longest(room)) is not None:
            used[n] += 1
            room -= n
        if room and len(sizes) > 1:
            smallest = min(used)
            used[smallest] -= 1
            pair = _tightest_pair(sizes, left, used, room + smallest, smallest)
            if pair is None:
                used[smallest] += 1
            else:
                used.update(pair)
        used = +used
        times = min(left[n] // k for n, k in used.items())
        bins.append((tuple(sorted(used.elements(), reverse=True)), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        sizes = [n for n in sizes if n in left]
    return bins


def _tightest_pair(sizes: list[int], left: dict[int, int], used: Counter, gap: int, over: int) -> tuple[int, int] | None:
    """Two lengths of greatest sum up to ``gap`` and above ``over``; two pointers, linear."""
    free = [n for n in sizes if left[n] > used[n]]
    low, high, best, found = 0, bisect_right(free, gap - 1) - 1, over, None
    while low <= high:
        a, b = free[low], free[high]
        if a + b > gap:
            high -= 1
        elif low == high and left[a] - used[a] < 2:
            break
        else:
            if a + b > best:
                best, found = a + b, (b, a)
                if best == gap:
                    break
            low += 1
    return found


def ranked(rows: DataFrame, size: str, order: list[str]) -> DataFrame:
    """Add ``rank``: gapless from 0 among rows of equal ``size``.

    A size that many rows share is ranked in blocks: a row number within
    (size, block), plus the rows of the blocks before, of which there are at
    most BLOCKS per size.
    """
    blocked = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(BLOCKS)))
    counts = blocked.groupBy(size, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(size).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(size, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(size, "_block").orderBy(*order)
    numbered = blocked.withColumn("_row", F.row_number().over(within) - 1)
    return (numbered.join(base, [size, "_block"])
            .withColumn("rank", F.col("_base") + F.col("_row")).drop("_block", "_base", "_row"))


def plan_slots(spark: SparkSession, bins: list[tuple[tuple[int, ...], int]]) -> DataFrame:
    """One row per (bin shape, distinct length): which ranks of the length it takes."""
    taken: Counter[int] = Counter()
    rows, first = [], 0
    for shape, times in bins:
        offset = 0
        for n in sorted(set(shape), reverse=True):
            k = shape.count(n)
            rows.append((n, taken[n], taken[n] + k * times, k, first, offset))
            taken[n] += k * times
            offset += n * k
        first += times
    return spark.createDataFrame(rows, "length long, first_rank long, end_rank long, each long, first_bin long, first_offset long")


def place(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to
    ``capacity``. ``order`` names columns that together tell rows apart; rows
    that are equal in all of them are placed in any order.

    Only the histogram of lengths (at most ``capacity`` rows) comes to the
    driver. Slots of one length are spread over buckets of its ranks, so that a
    length shared by a third of all rows does not meet in one task.
    """
    spark = pieces.sparkSession
    full = F.col("length") == capacity
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan_slots(spark, best_two_fit(counts, capacity))
    # a slot's ranks are cut into runs; a length has at most as many slots as bins shapes that use it
    numbers = ranked(pieces, "length", order)
    per_length = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "first_rank", "end_rank", "each", "first_bin", "first_offset"))).alias("slots"))
    # bounded by the plan: at most ``capacity`` rows, as many slots as the plan has
    joined = numbers.join(F.broadcast(per_length), "length")
    slot = F.element_at(F.filter("slots", lambda s: (s["first_rank"] <= F.col("rank")) & (F.col("rank") < s["end_rank"])), 1)
    at = F.col("rank") - F.col("slot.first_rank")
    return (joined.withColumn("slot", slot)
            .withColumn("sequence_id", F.col("slot.first_bin") + F.floor(at / F.col("slot.each")))
            .withColumn("offset", F.when(full, F.lit(0)).otherwise(
                F.col("slot.first_offset") + F.pmod(at, F.col("slot.each")) * F.col("length")))
            .drop("slot", "slots", "rank"))


@lru_cache(maxsize=2)
def json_tokenizer(vocabulary: str) -> ByteBpe:
    """The encoder of a ``tokenizers`` byte-level BPE file.

    Boundaries and the cache of pieces are this library's; pieces not seen
    before are merged by ``tiktoken`` with the file's vocabulary, whose ids are
    in the order of its merges, many at a time.
    """
    import tiktoken

    with open(vocabulary, encoding="utf-8") as f:
        model = json.load(f)
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}
    apart = tiktoken.Encoding("pieces", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
    mark = ranks[b"\0"]

    def merge_pieces(pieces: list[str]) -> list[bytes]:
        """All pieces in one call, zero bytes between them."""
        joined = "\0".join(pieces)
        try:
            ids = np.array(apart.encode_ordinary(joined), "<u4") if joined.count("\0") == len(pieces) - 1 else None
        except UnicodeEncodeError:  # lone surrogates
            ids = None
        if ids is None:
            return [np.array(merge(p.encode("utf-8", "surrogatepass"), ranks), "<u4").tobytes() for p in pieces]
        cuts, data = (4 * np.flatnonzero(ids == mark)).tolist(), ids.tobytes()
        return [data[i:j] for i, j in zip([0, *[c + 4 for c in cuts]], [*cuts, len(data)])]

    return ByteBpe(ranks, special, merge_pieces)


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
               with_ids: bool = False, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Tokenize whole texts and cut what is longer than a sequence.

    Per piece: ``keep``, ``copy`` (tells repeated rows apart), ``piece``,
    ``start``, ``length``, ``ids_crc32`` and, if asked, ``ids``. The first piece
    of a cut document is the short one. A NULL text is empty: its only id is
    ``end_id``. Repeated rows are documents of their own.
    """
    kept = Carried(docs, keep)
    held = kept.held
    ddl = kept.ddl + ", copy long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = json_tokenizer(vocabulary)
        for rows in batches:
            texts = rows["t"].tolist()
            for a, b in chunks(texts):
                made = [i + tail for i in bpe.encode(texts[a:b])]
                n = np.fromiter((len(i) // 4 for i in made), np.int64, b - a)
                parts = -(-n // capacity)
                first = n - (parts - 1) * capacity
                owner = np.repeat(np.arange(b - a), parts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[owner], capacity)
                cut = [made[o][4 * s:4 * (s + k)] for o, s, k in zip(owner.tolist(), start.tolist(), length.tolist())]
                out = rows.iloc[a:b].iloc[owner][[*held, "copy"]]
                out = out.assign(piece=piece, start=start, length=length, ids_crc32=[zlib.crc32(c) for c in cut])
                yield out.assign(ids=[np.frombuffer(c, "<i4") for c in cut]) if with_ids else out

    named = docs.select(*kept.columns, docs["text"].alias("t"), F.monotonically_increasing_id().alias("copy"))
    return kept.back(named.mapInPandas(run, ddl))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Pack all documents; one row per piece, see :func:`cut_pieces` and :func:`place`.

    The pieces are written to the shared folder once: the histogram, the ranks
    and the result read the same rows.
    """
    pieces = staged(cut_pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces")
    return place(pieces, ["doc_id", "copy", "piece"], capacity).drop("copy")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, its pieces in order; needs ``with_ids``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
