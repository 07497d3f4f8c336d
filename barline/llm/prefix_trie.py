"""Prefix trie of conversations, as double arrays per prefix shard.

A conversation is cut into segments of ``SEGMENT`` turns; a level holds the
segments of one number, and identical ones are one class with a count. Within a
level, classes with the same start and the same first turn are a shard; a shard
of more than ``SHARD`` classes is dealt out again by one turn more. A task packs
a shard's trie into BASE and CHECK arrays over the shard's dense turn ids and
walks it for the totals of its nodes. Nodes above the shards, which several of
them share, are merged from the totals of the shards' roots; the totals of a
level's starts hang on the ends of the level above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.ranked import ranked
from barline.llm.store import staged
from barline.session import stack

SEGMENT = 256
SHARD = 128
#: Conversation ids written into one string before it is hashed.
PIECE = 4096
ROOT = ""
NODES = ("start string, depth long, low long, parent long, n long, children long, leaves long, saved long, `end` string, "
         "shard string, ups array<string>, up_words array<long>, start_low long")


class DoubleArray:
    """A trie of integer sequences: the child of ``s`` by label ``x`` is
    ``BASE[s] + x`` if CHECK there is ``s``. Labels are 0 or more; a base may
    be negative. State 0 is the root; ``order`` lists parents before children."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.base, self.check, self.order = [0], [-2], [0]
        self._free = 1
        rows = sorted(set(map(tuple, sequences)))
        todo = [(0, 0, len(rows), 0)]
        while todo:
            state, low, high, depth = todo.pop()
            while low < high and len(rows[low]) == depth:
                low += 1
            parts = [(label, [i for i, _ in g]) for label, g in groupby(((i, rows[i][depth]) for i in range(low, high)), key=lambda x: x[1])]
            if not parts:
                continue
            base = self.base[state] = self._place([label for label, _ in parts])
            for label, inside in parts:
                child = base + label
                self.check[child] = state
                self.order.append(child)
                todo.append((child, inside[0], inside[-1] + 1, depth + 1))

    def _place(self, labels: list[int]) -> int:
        """The first base with a free slot for every label."""
        while self._free < len(self.check) and self.check[self._free] != -1:
            self._free += 1
        slot = self._free
        while True:
            base = slot - labels[0]
            reach = base + labels[-1] + 1
            if reach > len(self.check):
                more = reach - len(self.check)
                self.check.extend([-1] * more)
                self.base.extend([0] * more)
            if all(self.check[base + x] == -1 for x in labels):
                return base
            slot += 1

    def step(self, state: int, label: int) -> int | None:
        to = self.base[state] + label
        return to if 0 <= to < len(self.check) and self.check[to] == state else None

    def walk(self, labels: Sequence[int]) -> list[int]:
        """The states along a sequence that the trie holds, the root first."""
        path = [0]
        for x in labels:
            to = self.step(path[-1], x)
            if to is None:
                raise KeyError(x)
            path.append(to)
        return path


def shard_nodes(classes: list) -> list[tuple]:
    """The nodes of one shard from its classes: totals by walking each class and
    adding up from the leaves."""
    cut = int(classes[0].cut)
    known = {key: i for i, key in enumerate(sorted({k for c in classes for k in c.keys[cut:]}))}
    coded = [[known[k] for k in c.keys[cut:]] for c in classes]
    trie = DoubleArray(coded)
    size = len(trie.check)
    n, low, word, depth, end = [0] * size, [None] * size, [0] * size, [cut] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for c, labels in zip(classes, coded):
        path = trie.walk(labels)
        for at, state in enumerate(path):
            n[state] += int(c.n)
            low[state] = int(c.low) if low[state] is None else min(low[state], int(c.low))
            depth[state], word[state] = cut + at, int(c.words[cut + at - 1])
        end[path[-1]] = c.end
        children[path[-1]], leaves[path[-1]], saved[path[-1]] = int(c.hang_children), int(c.hang_leaves), int(c.hang_saved)
    for state in trie.order[1:]:
        children[trie.check[state]] += 1
    for state in reversed(trie.order):
        leaves[state] = leaves[state] if children[state] else 1
        saved[state] += (n[state] - 1) * word[state]
        if state:
            leaves[trie.check[state]] += leaves[state]
            saved[trie.check[state]] += saved[state]
    first = classes[0]
    made = [(first.start, depth[s], low[s], low[trie.check[s]] if s else None, n[s], children[s], leaves[s], saved[s], end[s],
             None, None, None, None) for s in trie.order]
    made[0] = (*made[0][:9], first.shard, list(first.ups), [0, *map(int, first.words[:cut - 1])], first.start_low)
    return made


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards arrive one after the other; one of them is held at a time."""
    columns = [c.split()[0].strip("`") for c in NODES.split(", ")]
    held: list = []
    for rows in batches:
        out = []
        for row in rows.itertuples(index=False):
            if held and held[0].shard != row.shard:
                out += shard_nodes(held)
                held = []
            held.append(row)
        yield _frame(out, columns)
    if held:
        yield _frame(shard_nodes(held), columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    made = pd.DataFrame(rows, columns=columns, dtype=object)
    numbers = ["depth", "low", "parent", "n", "children", "leaves", "saved", "start_low"]
    return made.astype(dict.fromkeys(numbers, "Int64"))


def digest(start, keys):
    return F.sha2(F.concat(start, F.array_join(keys, "")), 256)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``c``, ``pos``, ``turns`` (how many ``c`` has), ``key`` (of role and text) and ``words``."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    key = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn", key.alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return staged(ranked(rows, "c", ["turn", "key"]).select("c", "pos", F.col("group_rows").alias("turns"), "key", "words"), "turns")


def rebuilt(turns: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """Every conversation with the first turns of the one its id is rounded
    down to: as many as the CRC-32 of its id by ``shared`` says, in place of its
    own. One row per segment: ``c``, ``seg``, ``last``, ``keys`` and ``words``; a conversation without turns has one."""
    heads = turns.where((F.col("pos") < shared - 1) & (F.col("c") % family == 0)).groupBy(F.col("c").alias("giver")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("heads"))
    convs = turns.where("pos = 0").select("c", "turns", (F.crc32(F.col("c").cast("string").cast("binary")) % shared).cast("int").alias("h"),
                                          (F.col("c") - F.col("c") % family).alias("giver"))
    convs = convs.join(heads, "giver", "left").withColumn("heads", F.expr("slice(coalesce(heads, array()), 1, h)"))
    convs = convs.withColumn("total", F.size("heads") + F.greatest(F.col("turns") - F.col("h"), F.lit(0)))
    convs = staged(convs.select("c", "h", "heads", "total"), "convs")
    own = turns.join(convs.select("c", "h", "total", F.size("heads").alias("p")), "c").where("pos >= h")
    own = own.select("c", "total", (F.col("pos") - F.col("h") + F.col("p")).alias("pos"), "key", "words")
    given = convs.select("c", "total", F.explode("heads").alias("t")).select("c", "total", F.col("t.pos").cast("long").alias("pos"), "t.key", "t.words")
    none = convs.where("total = 0").select("c", "total", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("string").alias("key"),
                                           F.lit(0).cast("long").alias("words"))
    rows = stack(own, given, none).withColumn("seg", F.expr(f"pos div {SEGMENT}"))
    held = F.filter(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))), lambda t: t["key"].isNotNull())
    segs = rows.groupBy("c", "seg").agg(held.alias("t"), F.max("total").alias("total"))
    return segs.select("c", "seg", (F.col("total") <= (F.col("seg") + 1) * SEGMENT).alias("last"),
                       F.col("t.key").alias("keys"), F.col("t.words").alias("words"))


def _classes(members: DataFrame) -> DataFrame:
    """Identical segments of a level as one row."""
    return members.groupBy("start", "end").agg(
        F.first("keys").alias("keys"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("c").alias("low"),
        F.max("start_low").alias("start_low"))


def _shards(classes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Classes with their shard, and the classes that end above all shards.
    ``cut`` turns make the shard; ``ups`` are the digests of the shorter prefixes."""
    dealt, ended, left, cut = [], [], classes, 1
    while True:
        ended.append(left.where(F.size("keys") < cut).withColumn("cut", F.lit(cut)))
        sized = left.where(F.size("keys") >= cut).withColumn("cut", F.lit(cut)).withColumn(
            "shard", digest(F.col("start"), F.slice("keys", 1, cut)))
        hot = staged(sized.groupBy("shard").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("shard"), "hot")
        if hot.isEmpty():
            dealt.append(sized)
            break
        dealt.append(sized.join(hot, "shard", "left_anti"))
        left = staged(sized.join(hot, "shard", "left_semi").drop("shard"), "left")
        cut += 1
    ups = F.expr("transform(sequence(0, cut - 1), j -> if(j = 0, start, sha2(concat(start, array_join(slice(keys, 1, j), '')), 256)))")
    return stack(*dealt).withColumn("ups", ups), stack(*ended).withColumn("ups", ups)


def _shared_nodes(roots: DataFrame, ended: DataFrame) -> DataFrame:
    """The nodes above the shards of a level: ``start``, ``up`` (digest), ``depth``
    and their totals, from the roots of the shards and the classes that end above them."""
    tail = F.expr("hang_children"), F.expr("hang_leaves"), F.expr("hang_saved")
    below = roots.select("start", "start_low", "n", "low", "leaves", "saved", F.concat("ups", F.array("shard")).alias("chain"), "up_words",
                         F.size("ups").alias("reach"), F.lit(0).cast("long").alias("tail_children"))
    ends = ended.select("start", "start_low", "n", "low", tail[1].alias("leaves"), tail[2].alias("saved"), F.col("ups").alias("chain"),
                        F.concat(F.array(F.lit(0).cast("long")), F.expr("slice(words, 1, cut - 1)")).alias("up_words"),
                        F.size("ups").alias("reach"), tail[0].alias("tail_children"))
    each = stack(below, ends).withColumn("j", F.explode(F.expr("sequence(0, reach - 1)"))).select(
        "start", "start_low", "n", "low", "leaves", "saved", F.expr("chain[j]").alias("up"), F.expr("j").cast("long").alias("depth"),
        F.expr("get(chain, j + 1)").alias("child"), F.expr("up_words[j]").alias("word"), F.expr("slice(chain, 1, j + 1)").alias("above"),
        F.when(F.col("j") + 1 == F.size("chain"), F.col("tail_children")).otherwise(0).alias("tail_children"))
    keys = ["start", "up", "depth"]
    per_child = each.groupBy(*keys, "child").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max("word").alias("word"), F.max("above").alias("above"), F.max("start_low").alias("start_low"), F.sum("tail_children").alias("tail"))
    nodes = staged(per_child.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        F.max("word").alias("word"), F.max("above").alias("above"), F.max("start_low").alias("start_low"),
        (F.count("child") + F.sum("tail")).alias("children")), "upper")
    own = nodes.select("start", F.explode("above").alias("up"), ((F.col("n") - 1) * F.col("word")).alias("own")).groupBy("start", "up").agg(
        F.sum("own").alias("own"))
    full = nodes.join(own, ["start", "up"]).select(
        *keys, F.when(F.col("depth") == 0, F.coalesce("start_low", "low")).otherwise(F.col("low")).alias("low"), "n", "children",
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"),
        (F.col("saved") + F.col("own")).alias("saved"), F.expr("get(above, cast(depth as int) - 1)").alias("parent_up"))
    return staged(full, "upper")


def end_hashes(ends: DataFrame) -> DataFrame:
    """``end`` and the SHA-256 of its conversation ids, ascending and joined by
    commas. Ids are joined in many tasks; one task hashes the strings of an end, one after the other."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, name = [], None
        for rows in batches:
            out = []
            for end, c in zip(rows["end"], rows["c"]):
                if held and (end != name or len(held) >= PIECE):
                    out.append((name, held[0], ",".join(map(str, held))))
                    held = []
                name = end
                held.append(c)
            yield pd.DataFrame(out, columns=["end", "first", "ids"])
        if held:
            yield pd.DataFrame([(name, held[0], ",".join(map(str, held)))], columns=["end", "first", "ids"])

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, state = None, None
        for rows in batches:
            out = []
            for end, ids in zip(rows["end"], rows["ids"]):
                if end != name:
                    if state:
                        out.append((name, state.hexdigest()))
                    name, state = end, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(out, columns=["end", "ends_sha256"])
        if state:
            yield pd.DataFrame([(name, state.hexdigest())], columns=["end", "ends_sha256"])

    strings = ends.repartitionByRange(parts, "end", "c").sortWithinPartitions("end", "c").mapInPandas(join, "`end` string, first long, ids string")
    return strings.repartition(parts, "end").sortWithinPartitions("end", "first").mapInPandas(close, "`end` string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, most: int = SHARD) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see :func:`rebuilt`):
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns (``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored)
    go by ``turn``, NULL first, equal ones by a hash of role and text; NULL role
    or text is empty, repeated rows are turns of their own. Rows without a
    conv_id belong to no conversation. Without conversations there is no node.

    A task holds one shard: at most ``most`` classes of SEGMENT turns. As many
    rounds run as the longest conversation has segments; a number a round comes to the driver.
    """
    segs = staged(rebuilt(ordered_turns(conversations)), "segments")
    longest = segs.agg(F.max("seg")).first()[0]
    levels, ends, before = [], [], None
    for s in range(0 if longest is None else longest + 1):
        here = segs.where(F.col("seg") == s)
        if before is None:
            here = here.withColumns({"start": F.lit(ROOT), "start_low": F.lit(None).cast("long")})
        else:
            here = here.join(before, "c")
        named = here.withColumn("end", F.when(F.size("keys") == 0, F.col("start")).otherwise(digest(F.col("start"), F.col("keys"))))
        classes = staged(_classes(named), "classes")
        members = named.select("c", "last", "end")
        ends.append(members.where("last").select("c", "end"))
        before = members.where("not last").select("c", F.col("end").alias("start")).join(
            classes.select(F.col("end").alias("start"), F.col("low").alias("start_low")), "start")
        if s < longest:
            before = staged(before, "starts")
        levels.append(classes)
    found, hanging = [], None
    for s, classes in reversed(list(enumerate(levels))):
        if hanging is not None:
            classes = classes.join(hanging, "end", "left")
        names = ("hang_children", "hang_leaves", "hang_saved")
        classes = classes.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") if hanging is not None else F.lit(0).cast("long") for c in names})
        dealt, ended = _shards(staged(classes, "classes") if hanging is not None else classes, most)
        parts = int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        packed = dealt.repartition(parts, "shard").sortWithinPartitions("shard").mapInPandas(_packed, NODES)
        nodes = staged(packed, "nodes")
        upper = _shared_nodes(nodes.where("shard is not null"), ended)
        lows = upper.select(F.col("start").alias("_start"), F.col("up").alias("_up"), F.col("low").alias("_low"))
        inner = nodes.where("shard is null").select("low", "depth", "parent", "n", "children", "leaves", "saved", "end")
        tops = nodes.where("shard is not null").withColumn("parent_up", F.element_at("ups", -1))
        shown = upper if s == 0 else upper.where("depth > 0")
        joints = stack(tops.select("start", "parent_up", "low", "depth", "n", "children", "leaves", "saved", "end"),
                       shown.select("start", "parent_up", "low", "depth", "n", "children", "leaves", "saved", F.col("up").alias("end")))
        joints = joints.join(lows, (F.col("start") == F.col("_start")) & (F.col("parent_up") == F.col("_up")), "left")
        found.append(stack(inner, joints.withColumn("parent", F.col("_low")).select(inner.columns)).withColumn(
            "depth", F.col("depth") + s * SEGMENT))
        hanging = upper.where("depth = 0").select(F.col("up").alias("end"), F.col("children").alias("hang_children"),
                                                  F.col("leaves").alias("hang_leaves"), F.col("saved").alias("hang_saved"))
    if not found:
        return segs.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                                     "n_leaves long, saved_tokens long, ends_sha256 string")
    joined = stack(*found).join(end_hashes(stack(*ends)), "end", "left")
    return joined.select(
        F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
