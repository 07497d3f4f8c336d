"""Resharding by minimum-cost flow: move as few bytes as the new sizes allow.

Old shards are sources of their bytes, new shards sinks of theirs; a byte that
stays costs nothing, one that moves costs one. The flow is solved on the shard
sizes alone. The blocks of each old shard, hash ranges of its documents, are then
cut into runs of the sizes that the flow sends to each new shard, and only the
shards that win or lose bytes are written anew.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barline.llm.store import staged
from barline.session import scratch_path, stack

SHARDS = 16
#: Blocks of all old shards together, about; a block is what is moved.
BLOCKS = 1 << 18


def min_cost_flow(supply: list[int], demand: list[int], cost: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Cheapest flow from sources to sinks over the arcs of ``cost``, by
    successive shortest paths with potentials. Supplies and demands have equal
    sums, and every source reaches every sink."""
    n, m = len(supply), len(demand)
    end, graph = n + m + 1, defaultdict(list)  # 0 is the origin, 1..n sources, then sinks, then the end
    arcs: list[list[int]] = []  # head, room, cost; arc i ^ 1 runs back

    def arc(a: int, b: int, room: int, c: int) -> None:
        graph[a].append(len(arcs))
        arcs.append([b, room, c])
        graph[b].append(len(arcs))
        arcs.append([a, 0, -c])

    for i, s in enumerate(supply):
        arc(0, i + 1, s, 0)
    first = len(arcs)
    for (i, j), c in cost.items():
        arc(i + 1, n + j + 1, min(supply[i], demand[j]), c)
    last = len(arcs)
    for j, d in enumerate(demand):
        arc(n + j + 1, end, d, 0)
    potential = [0] * (end + 1)
    left = sum(supply)
    while left:
        far, came = {0: 0}, {}
        heap = [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > far[a]:
                continue
            for k in graph[a]:
                b, room, c = arcs[k]
                if room and (new := d + c + potential[a] - potential[b]) < far.get(b, 1 << 62):
                    far[b], came[b] = new, k
                    heapq.heappush(heap, (new, b))
        if end not in far:
            raise ValueError("supply and demand don't match")
        for a in range(end + 1):
            potential[a] += min(far.get(a, far[end]), far[end])
        path, b = [], end
        while b:
            path.append(came[b])
            b = arcs[came[b] ^ 1][0]
        push = min(left, *(arcs[k][1] for k in path))
        for k in path:
            arcs[k][1] -= push
            arcs[k ^ 1][1] += push
        left -= push
    keys = iter(cost)
    return {next(keys): arcs[k + 1][1] for k in range(first, last, 2)}


def transfers(sizes: dict[int, int], shards: int = SHARDS) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one, the new ones as equal as can
    be. The larger capacities go to the old shards that hold more."""
    old = sorted(sizes)
    total = sum(sizes.values())
    share, rest = divmod(total, shards)
    order = sorted(range(shards), key=lambda j: (-sizes.get(j, 0), j))
    room = {j: share + (k < rest) for k, j in enumerate(order)}
    cost = {(i, j): int(old[i] != j) for i in range(len(old)) for j in range(shards)}
    flow = min_cost_flow([sizes[s] for s in old], [room[j] for j in range(shards)], cost)
    return {(old[i], j): f for (i, j), f in flow.items() if f}


def old_shards(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with ``old_shard``: the place of its file among all
    of them, by name. File names come to the driver, rows don't."""
    docs = spark.read.parquet(path)
    names = sorted({f.rsplit("/", 1)[-1] for f in docs.inputFiles()})
    known = spark.createDataFrame([(unquote(n), i) for i, n in enumerate(names)] or [("", 0)], "_file string, old_shard int")
    # bounded by the number of files
    return docs.withColumn("_file", F.col("_metadata.file_name")).join(F.broadcast(known), "_file").drop("_file")


def measured(docs: DataFrame) -> DataFrame:
    """Add ``size`` (UTF-8 bytes of the text, plus 1) and ``text_crc32``; a NULL text has no bytes."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.withColumns({"size": (F.octet_length(text) + 1).cast("long"), "text_crc32": F.crc32(text)})


@dataclass
class Plan:
    """``blocks`` (old_shard, block, shard), at most BLOCKS rows; ``flow`` in
    bytes between shards; shards that win or lose bytes; blocks per old shard."""

    blocks: DataFrame
    flow: dict[tuple[int, int], int]
    touched: list[int]
    per_shard: int


def _block(per_shard: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(per_shard)).cast("int")


def plan(docs: DataFrame, shards: int = SHARDS) -> Plan:
    """Which block of which old shard goes where. Only one size per old shard
    comes to the driver; blocks are cut in Spark. A block goes where the middle of
    its bytes falls, so that a shard misses its size by a block at each cut."""
    spark = docs.sparkSession
    old = docs.agg(F.max("old_shard")).first()[0]
    per_shard = max(64, BLOCKS // ((old or 0) + 1))
    sizes = staged(docs.groupBy("old_shard", _block(per_shard).alias("block")).agg(F.sum("size").alias("bytes")), "blocks")
    totals = {r["old_shard"]: r["b"] for r in sizes.groupBy("old_shard").agg(F.sum("bytes").alias("b")).collect()}
    flow = transfers(totals, shards)
    cuts, at = [], {s: 0 for s in totals}
    for s, j in sorted(flow, key=lambda e: (e[0], e[1] != e[0], e[1])):  # what stays comes first
        cuts.append((s, 2 * at[s], 2 * (at[s] + flow[s, j]), j))
        at[s] += flow[s, j]
    cut = spark.createDataFrame(cuts, "old_shard int, low long, high long, shard int")
    run = Window.partitionBy("old_shard").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = sizes.withColumn("middle", 2 * F.sum("bytes").over(run) - F.col("bytes"))
    # a join on equality with at most as many rows per key as there are new shards
    where = (F.col("low") <= F.col("middle")) & (F.col("middle") < F.col("high"))
    blocks = middle.join(F.broadcast(cut), "old_shard").where(where).select("old_shard", "block", "shard")
    touched = sorted({x for s, j in flow if s != j for x in (s, j)})
    return Plan(staged(blocks, "plan"), flow, touched, per_shard)


def reshard(docs: DataFrame, shards: int = SHARDS, path: str | None = None) -> tuple[DataFrame, Plan]:
    """All rows and columns of ``docs`` with ``shard`` and ``block``, after the
    shards that win or lose bytes were written anew under ``path``, one folder
    each; the other shards are read where they are.

    ``docs`` has ``old_shard``, ``doc_id`` and ``text``; other columns are carried
    along, and those named ``size``, ``text_crc32``, ``shard`` or ``block`` are
    replaced. NULL ids and texts, empty texts and repeated rows are rows like
    others. The texts are shuffled once, by shard and hash, so that files of a
    large shard are written by many tasks.
    """
    spark = docs.sparkSession
    rows = measured(docs)
    made = plan(rows.select("old_shard", "doc_id", "size", "text_crc32"), shards)
    # at most BLOCKS rows, or 64 per old shard
    placed = rows.drop("shard", "block").withColumn("block", _block(made.per_shard)).join(F.broadcast(made.blocks), ["old_shard", "block"])
    moved = placed.where(F.col("shard").isin(made.touched)) if made.touched else placed.limit(0)
    path = path or scratch_path(spark, "shards")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (moved.repartitionByRange(n, "shard", F.xxhash64("block", "doc_id")).write.partitionBy("shard").parquet(path))
    types = StructType([f for f in moved.schema if f.name != "shard"] + [f for f in moved.schema if f.name == "shard"])
    written = spark.read.schema(types).parquet(path)
    still = placed.where(~F.col("shard").isin(made.touched))
    return (stack(written, still) if len(made.touched) < shards else written), made


def slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``: gapless from 0 in each ``shard``, by old shard, block and
    doc_id. Rows are ranked within their block; blocks are counted first."""
    count = rows.groupBy("shard", "old_shard", "block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("old_shard", "block").rowsBetween(Window.unboundedPreceding, -1)
    base = count.select("shard", "old_shard", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("shard", "old_shard", "block").orderBy("doc_id", "text_crc32")
    ranked = rows.withColumn("_row", F.row_number().over(within) - 1)
    return (ranked.join(base, ["shard", "old_shard", "block"])
            .withColumn("slot", (F.col("_base") + F.col("_row")).cast("long")).drop("_base", "_row"))
