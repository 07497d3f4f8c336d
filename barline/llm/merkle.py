"""Merkle manifest of a table, by strings that hold a whole level.

The leaves of a group are cut into aligned blocks of ``FAN ** LEVELS``. Within a
block a level is one string of concatenated hex digests: fixed-width substrings
of it are hashed to the level above, and what lies left and right of a node in
its run of ``FAN`` is its proof segment. The tops of the blocks are the leaves
of the next round, until each group has one top; the tops of the groups, in
order, are the leaves of the last tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.ranked import ranked
from barline.llm.store import staged
from barline.session import stack

FAN = 8
#: Levels a block is folded at once: a block has at most FAN ** LEVELS leaves.
LEVELS = 3
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One step up: the text of the siblings before and after the node.
PATH = "array<struct<left:string,right:string>>"


def leaf_hash(columns: Sequence[str], replaced: Mapping[str, Column] | None = None) -> Column:
    """SHA-256, in hex, of the values of a row, in the given order: ``-`` for
    NULL, else the number of UTF-8 bytes, a colon and the value. ``replaced``
    gives other values for some columns."""
    parts = []
    for name in columns:
        value = (replaced or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


#: SQL: how often ``group_rows`` nodes are folded until one is left, by comparing with powers of FAN.
_HEIGHT = " + ".join(f"cast(group_rows > {FAN ** k}L as int)" for k in range(21))


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (``g``, ``pos``, ``group_rows``, ``node``, ``rest``) in blocks:
    ``levels`` are the strings of the levels below the block's ``top``."""
    run = FAN * WIDTH
    out = nodes.groupBy("g", F.expr(f"pos div {FAN ** LEVELS}").alias("block")).agg(
        F.max("group_rows").alias("group_rows"), F.sort_array(F.collect_list(F.struct("pos", "node", "rest"))).alias("members"))
    out = out.withColumn("height", F.expr(f"least({LEVELS}, {_HEIGHT})")).withColumn("level0", F.array_join("members.node", ""))
    for k in range(LEVELS):
        parents = (f"transform(sequence(0, (length(level{k}) - 1) div {run}), "
                   f"i -> sha2(substring(level{k}, i * {run} + 1, {run}), 256))")
        out = out.withColumn(f"level{k + 1}", F.expr(f"if(height > {k}, array_join({parents}, ''), level{k})"))
    return out.select("g", "block", "group_rows", "height", "members",
                      F.array(*[f"level{k}" for k in range(LEVELS)]).alias("levels"), F.col(f"level{LEVELS}").alias("top"))


def _grow(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of every round, the leaves' first. One number a round comes to the driver."""
    size, rounds = FAN ** LEVELS, []
    while True:
        blocks = staged(_blocks(nodes), "merkle")
        rounds.append(blocks)
        most = blocks.agg(F.max("group_rows")).first()[0]
        if most is None or most <= size:
            return rounds
        nodes = blocks.where(f"group_rows > {size}").select(
            "g", F.col("block").alias("pos"), F.expr(f"(group_rows + {size - 1}) div {size}").alias("group_rows"),
            F.col("top").alias("node"), F.lit(None).cast(blocks.schema["members"].dataType.elementType["rest"].dataType).alias("rest"))


def _ended(blocks: DataFrame) -> DataFrame:
    """The one block of each group that gets its top in this round."""
    return blocks.where(f"group_rows <= {FAN ** LEVELS}")


def _with_paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The members of all blocks with their path: the flanks of their runs
    within the block, then the path that ``above`` (``g``, ``pos``) has for the block."""
    run = FAN * WIDTH
    above = above.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("path").alias("_path"), "subroot", "root")
    joined = blocks.join(above, F.col("g").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_pos")))
    at = f"cast((m.pos - block * {FAN ** LEVELS}) div cast(power({FAN}, k) as bigint) as int)"  # the node's place in level k
    siblings = f"substring(levels[k], {at} div {FAN} * {run} + 1, {run})"
    own = (f"transform(filter(sequence(0, {LEVELS - 1}), k -> k < height), k -> struct("
           f"substring({siblings}, 1, {at} % {FAN} * {WIDTH}) as left, substring({siblings}, ({at} % {FAN} + 1) * {WIDTH} + 1) as right))")
    member = f"transform(members, m -> struct(m.pos, m.node, m.rest, concat({own}, _path) as path))"
    each = joined.select("g", "subroot", "root", F.explode(F.expr(member)).alias("m"))
    return each.select("g", "m.pos", "m.node", "m.rest", "m.path", "subroot", "root")


def _descend(rounds: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The leaves with their whole path; ``ends`` (``g``, ``path``, ``subroot``,
    ``root``) is what lies above the top of each group."""
    below = None
    for blocks in reversed(rounds):
        done = _ended(blocks).select(F.col("g").alias("_h"))
        done = ends.join(done, F.col("g").eqNullSafe(F.col("_h"))).select("g", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root")
        below = _with_paths(blocks, done if below is None else stack(done, below.select(done.columns)))
    return below


def merkle_manifest(docs: DataFrame, columns: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id",
                    also: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``group``, ``leaf``, ``subroot`` of
    its group, ``root`` of the table, ``path`` (the siblings left and right of
    each node from the leaf up to the root) and the columns of ``also``, which
    are computed in the pass that hashes the rows.

    The leaves of a group ascend by ``key``, NULL first, equal keys by their
    hash; a group is folded FAN nodes at a time, a last run of one too, until one
    is left. The tops of the groups ascend by group, NULL (a group of its own)
    first, and are folded likewise. Repeated rows are leaves of their own. Other
    columns are ignored, whatever their names. A table without rows gives none.

    Nothing longer than one block's level is in one task: groups are numbered by
    range parts, and each round leaves one node in FAN ** LEVELS.
    """
    also = dict(also or {})
    hashed = docs.select(F.col(group).alias("g"), F.col(key).alias("_key"), leaf_hash(columns).alias("node"),
                         F.struct(*[c.alias(n) for n, c in also.items()], F.lit(1).alias("_")).alias("_also"))
    leaves = ranked(hashed, "g", ["_key", "node"])
    rounds = _grow(leaves.select("g", "pos", "group_rows", "node", F.struct("_key", "_also").alias("rest")))
    tops = stack(*[_ended(r).select(F.lit(0).alias("g"), F.col("g").alias("name"), F.col("top").alias("node")) for r in rounds])
    upper = _grow(ranked(tops, "g", ["name", "node"]).select("g", "pos", "group_rows", "node", F.struct("name").alias("rest")))
    root = _ended(upper[-1]).select(F.lit(0).alias("g"), F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.col("top").alias("root"))
    ends = _descend(upper, root).select(F.col("rest.name").alias("g"), "path", F.col("node").alias("subroot"), "root")
    found = _descend(rounds, ends)
    return found.select(F.col("rest._key").alias(key), F.col("g").alias(group), F.col("node").alias("leaf"), "subroot", "root", "path",
                        *[F.col(f"rest._also.{n}").alias(n) for n in also])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of a path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
