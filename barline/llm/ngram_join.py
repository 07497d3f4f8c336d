"""Similarity join of documents on word shingles, with Bayesian pruning.

Equal texts form a class and are compared once. Classes that agree on a band of
MinHash values are compared value by value: a pair is dropped as soon as the
posterior probability that its Jaccard similarity reaches the threshold falls
below the tolerance, and the rest are verified on their shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.components import components, roots
from barline.llm.ragged import chunks, mix, shingle_hashes
from barline.llm.store import Carried, runtime_filters, staged
from barline.session import stack

WORDS, THRESHOLD = 5, 0.8
#: 32 bands of 4 values: a pair at the threshold shares no band with probability 5e-8.
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
#: Values compared between two looks at the posterior.
STEP = 32
TOLERANCE = 1e-6
#: Classes of one block. Larger buckets are split and compared block by block.
BLOCK = 400
#: A text with more than one in so many of the rows is hot.
HOT_SHARE = 1000


@lru_cache
def least_matches(threshold: float, tolerance: float) -> tuple[tuple[int, int], ...]:
    """(values compared, fewest matches that keep a pair), at every look.

    With a uniform prior the posterior after m matches of n is Beta(m + 1,
    n - m + 1); it exceeds t with the probability that a Binomial(n + 1, t) is
    at most m.
    """
    looks = []
    for n in range(STEP, VALUES + 1, STEP):
        reach = 0.0
        for m in range(n + 1):
            reach += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if reach >= tolerance:
                looks.append((n, m))
                break
    return tuple(looks)


@lru_cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:VALUES] | np.uint64(1), seeds[VALUES:]


def minhash(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values (one row of VALUES per text) and numbers of shingles."""
    h, at = shingle_hashes(texts, words)
    sizes = np.diff(at)
    out = np.full((len(texts), VALUES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(sizes)
    if len(some):
        first = at[:-1][some]
        for k, (a, b) in enumerate(zip(*_multipliers())):
            out[some, k] = np.minimum.reduceat((h * a + b) >> np.uint64(32), first)
    return out, sizes


def _digest(text):
    """By this texts are equal."""
    return F.unhex(F.sha2(text, 256))


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``digest`` of the text, ``size`` (shingles) and ``sig`` of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            texts = rows["t"].tolist()
            for a, b in chunks(texts, 300_000):
                sig, size = minhash(texts[a:b], words)
                yield rows.iloc[a:b][[*held, "digest"]].assign(size=size, sig=[s.tobytes() for s in sig])

    carried = Carried(docs, ["doc_id"])
    held = carried.held
    text = F.coalesce(docs["text"], F.lit(""))
    named = docs.select(*carried.columns, _digest(text).alias("digest"), text.alias("t"))
    return carried.back(named.mapInPandas(run, carried.ddl + ", digest binary, size long, sig binary"))


def _bands(classes: DataFrame) -> DataFrame:
    """One row per class and band; ``bucket`` is the hash of the band's values with the band's number in its low bits."""
    width = ROWS * 4
    keys = [F.xxhash64(F.substring("sig", i * width + 1, width)).bitwiseAND(F.lit(-BANDS)).bitwiseOR(F.lit(i))
            for i in range(BANDS)]
    return classes.select("class_id", F.explode(F.array(*keys)).alias("bucket"))


def candidate_groups(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """``class_id``, ``bucket``, ``side`` and the block pair (``i``, ``j``) of
    every group in which a class is to be compared.

    Buckets of the same members are kept once, for the first band. A bucket of
    more than ``block`` classes is split into blocks, and each pair of blocks is
    a group of its own.
    """
    rows = _bands(classes)
    buckets = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("class_id").alias("first"), F.bit_xor(F.xxhash64("class_id")).alias("x"),
        F.bit_xor(F.xxhash64("class_id", F.lit(1))).alias("y")).where("n > 1")
    order = F.struct(F.col("bucket").bitwiseAND(F.lit(BANDS - 1)).alias("band"), "bucket")
    kept = buckets.groupBy("n", "first", "x", "y").agg(F.min(order).alias("k")).select("n", F.col("k.bucket").alias("bucket"))
    member = rows.join(staged(kept, "buckets").where("n > 1"), "bucket").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    member = member.withColumn("side", F.pmod(F.xxhash64("class_id", F.lit(7)), F.col("blocks")).cast("int"))
    other = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("class_id", "bucket", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))


def _candidates(g: pd.DataFrame, looks: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of one group that belong to its band and that the
    posterior does not rule out."""
    i, j = g["i"].iat[0], g["j"].iat[0]
    side, band = g["side"].to_numpy(), int(g["bucket"].iat[0]) & BANDS - 1
    sig = np.frombuffer(b"".join(g["sig"]), np.uint32).reshape(len(g), VALUES)
    if i != j:
        a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == i), np.flatnonzero(side == j), indexing="ij"))
    else:
        a, b = np.triu_indices(len(g), 1)
    matches, done = np.zeros(len(a), np.int64), 0
    for upto, least in looks:
        for s in range(0, len(a), 100_000):
            part = slice(s, s + 100_000)
            matches[part] += (sig[a[part], done:upto] == sig[b[part], done:upto]).sum(axis=1)
        keep = matches >= least
        a, b, matches, done = a[keep], b[keep], matches[keep], upto
    own = np.zeros(len(a), bool)  # a pair is counted in the first band that it shares
    for s in range(0, len(a), 50_000):
        part = slice(s, s + 50_000)
        same = (sig[a[part]] == sig[b[part]]).reshape(-1, BANDS, ROWS).all(axis=2)
        own[part] = (same.argmax(axis=1) == band) & same[:, band]
    return a[own], b[own]


def _verified(texts: list[str], a: np.ndarray, b: np.ndarray, words: int, threshold: float) -> np.ndarray:
    """Which pairs of texts reach the threshold, by their shingle sets."""
    used = np.unique(np.concatenate((a, b)))
    h, at = shingle_hashes([texts[i] for i in used], words)
    size = np.diff(at)
    a, b = np.searchsorted(used, a), np.searchsorted(used, b)
    _, column, times = np.unique(h, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(used)), size)
    shared = times[column] > 1
    row, (_, column) = row[shared], np.unique(column[shared], return_inverse=True)
    both = np.zeros((len(used), len(used)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    wide = int(column[-1]) + 1 if len(column) else 0
    for s in range(0, wide, 4096):  # bounded slices of the incidence table
        lo, hi = np.searchsorted(column, (s, s + 4096))
        table = np.zeros((len(used), min(4096, wide - s)), np.float32)
        table[row[lo:hi], column[lo:hi] - s] = 1
        both += table @ table.T
    common = both[a, b].astype(np.int64)
    return common >= threshold * (size[a] + size[b] - common) - 1e-9


def _each_group(groups: DataFrame, one: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``one`` over the rows of every group of two classes or more, a group at a
    time; groups are bounded by two blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for rows in batches:
            rows = rows if held is None else pd.concat((held, rows), ignore_index=True)
            key = rows[["bucket", "i", "j"]].to_numpy()
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
            made = [m for s, e in zip(edges, edges[1:]) if e - s > 1 and (m := one(rows.iloc[s:e])) is not None]
            if made:
                yield pd.concat(made)
            held = rows.iloc[edges[-1]:]
        if held is not None and len(held) > 1 and (m := one(held)) is not None:
            yield m

    return groups.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInPandas(run, schema)


def surviving(groups: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """The memberships of ``groups`` (with ``sig``) that hold a pair to verify.
    Values are compared step by step; texts are not needed for it."""
    looks = least_matches(threshold, tolerance)
    kind = groups.schema["class_id"].dataType.simpleString()
    columns = ["class_id", "bucket", "side", "i", "j"]

    def one(g: pd.DataFrame) -> pd.DataFrame | None:
        a, b = _candidates(g, looks)
        return g.iloc[np.unique(np.concatenate((a, b)))][columns] if len(a) else None

    return _each_group(groups, one, f"class_id {kind}, bucket long, side int, i int, j int")


def compare_groups(groups: DataFrame, words: int = WORDS, threshold: float = THRESHOLD,
                   tolerance: float = TOLERANCE) -> DataFrame:
    """Per class and group: numbers of linked classes and documents, and the
    smallest class that links reach within the group. No pair leaves the task."""
    looks = least_matches(threshold, tolerance)
    kind = groups.schema["class_id"].dataType.simpleString()

    def one(g: pd.DataFrame) -> pd.DataFrame | None:
        g = g.sort_values("class_id")
        ids, copies = g["class_id"].to_numpy(), g["copies"].to_numpy()
        a, b = _candidates(g, looks)
        other = ids[a] != ids[b]
        a, b = a[other], b[other]
        if len(a):
            near = _verified(g["text"].tolist(), a, b, words, threshold)
            a, b = a[near], b[near]
        if not len(a):
            return None
        n = len(g)
        links = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        docs = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
        some = np.flatnonzero(links)
        return pd.DataFrame({"class_id": ids[some], "links": links[some], "docs": docs[some].astype(np.int64),
                             "root": ids[roots(n, a, b)[some]]})

    return _each_group(groups, one, f"class_id {kind}, links long, docs long, root {kind}")


def _with_class(rows: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``rows`` with what is known of their text, NULL where nothing is. Copies
    of one text would meet in one task: texts with more than a HOT_SHAREth of the ``n`` rows, of
    which there are fewer than HOT_SHARE, are sent to the rows instead."""
    hot = F.col("copies") > max(1, n // HOT_SHARE)
    placed = rows.join(F.broadcast(known.where(hot)), "digest", "left")
    rest = placed.where(F.col("class_id").isNull()).select(rows.columns)
    return stack(placed.where(F.col("class_id").isNotNull()), rest.join(known.where(~hot), "digest", "left"))


def ngram_join(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
               block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are ignored).

    ``class_id`` is the smallest doc_id with an equal text, ``n_links`` the number
    of other documents linked (equal texts, and texts whose sets of
    ``words``-word shingles have a Jaccard similarity of ``threshold`` or more),
    ``component_id`` the smallest doc_id that links reach, ``kept`` whether the
    row is the one that stays of its component.

    Words are runs of characters other than ASCII white space; a text of fewer
    words is one shingle. A text without words (NULL, empty, blank) and a row
    whose doc_id is NULL link with nothing and stay. Repeated rows are copies of
    each other, and one of them stays. A doc_id with several texts is one node
    with the links of all of them.
    """
    rows = staged(signatures(docs, words).withColumn("row", F.monotonically_increasing_id()), "signatures")
    full = rows.where("size > 0 and doc_id is not null")
    first = F.min(F.struct("doc_id", "row"))
    classes = staged(full.groupBy("digest").agg(first.alias("f"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
                     .select("digest", F.col("f.doc_id").alias("class_id"), F.col("f.row").alias("row"), "copies", "sig"), "classes")
    with runtime_filters(docs.sparkSession):  # most texts have no candidate and need not be shuffled
        groups = candidate_groups(classes, block).join(classes.select("class_id", "sig"), "class_id")
        groups = staged(surviving(groups, threshold, tolerance), "groups")
        wanted = groups.groupBy("class_id").agg(F.count("*").alias("n"))
        wanted = staged(classes.select("digest", "class_id", "copies", "sig").join(wanted, "class_id"), "wanted")
        texts = docs.select(F.col("doc_id").alias("class_id"), "text").join(wanted.where("n > 0"), "class_id")
        texts = texts.where(F.col("digest") == _digest(F.col("text"))).dropDuplicates(["class_id", "digest"])
        compared = groups.join(texts.drop("digest", "n"), "class_id")
        found = staged(compare_groups(compared, words, threshold, tolerance), "links")
    totals = found.groupBy("class_id").agg(F.sum("docs").alias("docs"))
    joined = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    known = staged(classes.select("digest", "class_id", "copies", F.col("row").alias("first_row"))
                   .join(totals, "class_id", "left").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
                   .where("copies > 1 or component is not null"), "known")
    whole = F.col("size") > 0
    out = _with_class(rows.select("doc_id", "row", "size", "digest"), known, classes.agg(F.sum("copies")).first()[0] or 0)
    linked = F.col("class_id").isNotNull() & F.col("doc_id").isNotNull() & whole
    pick = lambda c, other: F.when(linked, c).otherwise(other)
    component = F.coalesce("component", "class_id")
    return out.select(
        "doc_id", pick(F.col("class_id"), F.col("doc_id")).alias("class_id"),
        pick(F.col("copies") - 1 + F.coalesce("docs", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        pick(component, F.col("doc_id")).alias("component_id"),
        pick((component == F.col("class_id")) & (F.col("row") == F.col("first_row")), F.lit(True)).alias("kept"), "digest")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without all but one of each component."""
    verdict = ngram_join(docs, **options)
    gone = verdict.where(~F.col("kept")).select("doc_id", "digest").distinct()
    # a repeated row that stays shares its key with copies that go
    stays = verdict.where("kept").select("doc_id", "digest").distinct()
    gone = gone.join(stays, ["doc_id", "digest"], "left_anti")
    again = (verdict.where(F.col("doc_id").isNotNull()).groupBy("doc_id", "digest")
             .agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).where("n > 1 and k = 1").drop("n", "k"))
    again = staged(again, "repeated")
    keyed = docs.withColumn("_digest", _digest(F.coalesce("text", F.lit(""))))
    left = keyed.join(gone, (keyed["doc_id"] == gone["doc_id"]) & (keyed["_digest"] == gone["digest"]), "left_anti")
    if not again.isEmpty():
        on = (left["doc_id"] == again["doc_id"]) & (left["_digest"] == again["digest"])
        repeated = left.join(again, on, "left_semi").dropDuplicates(["doc_id", "_digest"])
        left = left.join(again, on, "left_anti").union(repeated)
    return left.select(*docs.columns)
