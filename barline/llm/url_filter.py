"""URL rules by a cascade of Bloom filters.

The keys a corpus can ask about are known: every host suffix and path prefix of
the shapes that rules have. The first filter of a cascade holds the listed keys,
the second those corpus keys that the first lets through by mistake, the third
the listed keys that the second catches by mistake, and so on until nothing is
left over. Whoever walks the levels gets the exact answer for every key of the
corpus, and no corpus row is joined with anything.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.store import staged

FALSE_SHARE = 0.01
#: Bytes of filters that tasks hold at a time; rules of more are split by key hash and take several passes.
MOST_BYTES = 256 << 20
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), LETTERS, LETTERS.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def shapes_of(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, characters of the path) that rules have, most
    specific first. Bounded by the forms of rules, not by their number."""
    rows = rules.select(F.size(F.split("host", r"\.")).alias("a"), F.length("path").alias("b")).distinct().collect()
    return sorted(((r["a"], r["b"]) for r in rows), reverse=True)


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Keys that could be a rule for the url, longest first, then longest host."""
    parts = F.split(host, r"\.")
    keys = []
    for labels, length in shapes:
        # a rule on all of a host, or on what follows one of its dots
        suffix = F.array_join(F.slice(parts, F.size(parts) - labels + 1, labels), ".")
        fits = (F.size(parts) >= labels) & (F.length(path) >= length)
        key = F.concat(suffix, F.substring(path, 1, length))
        keys.append(F.when(fits, F.struct(-F.length(key), -F.length(suffix), key.alias("key"))))
    found = F.filter(F.array(*keys), lambda k: k.isNotNull()) if keys else F.array().cast("array<struct<a:int,b:int,key:string>>")
    return F.transform(F.sort_array(found), lambda k: k["key"])


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


@dataclass
class Bloom:
    words: np.ndarray
    hashes: int

    @staticmethod
    def of(n: int, share: float) -> "Bloom":
        bits = max(64, ceil(-n * log(share) / log(2) ** 2))
        return Bloom(np.zeros(-(-bits // 64), np.uint64), max(1, round(bits / max(n, 1) * log(2))) if n else 1)

    def _places(self, h1: np.ndarray, h2: np.ndarray, i: int, level: int) -> np.ndarray:
        h = h1 + h2 * np.uint64(i + 1) + np.uint64(level) * (h2 >> np.uint64(17) | np.uint64(1))
        return (h ^ (h >> np.uint64(31))) % np.uint64(len(self.words) * 64)

    def holds(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(h1), bool)
        for i in range(self.hashes):
            p = self._places(h1, h2, i, level)
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def _build(keys: DataFrame, n: int, share: float, level: int) -> Bloom:
    """A filter of the keys (``h1``, ``h2``). Tasks send the words that they
    set, which are or-ed in Spark; the filter's own size bounds what arrives."""
    bloom = Bloom.of(n, share)

    def run(batches):
        for rows in batches:
            h1, h2 = (rows[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
            p = np.unique(np.concatenate([bloom._places(h1, h2, i, level) for i in range(bloom.hashes)])) if len(h1) else np.zeros(0, np.uint64)
            word, first = np.unique(p >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), first) if len(first) else p
            yield pd.DataFrame({"w": word.astype(np.int64), "b": bits.view(np.int64)})

    rows = keys.mapInPandas(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    bloom.words[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)
    return bloom


@dataclass
class Cascade:
    levels: list[Bloom]

    def lists(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Which keys are listed. A key that first fails at an odd level is."""
        out, open_ = np.zeros(len(h1), bool), np.arange(len(h1))
        for level, bloom in enumerate(self.levels):
            held = bloom.holds(h1[open_], h2[open_], level)
            out[open_[~held]] = level % 2 == 1
            open_ = open_[held]
        out[open_] = len(self.levels) % 2 == 1
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, share: float = FALSE_SHARE) -> Cascade:
    """``listed`` and ``universe`` hold keys as ``key``, ``h1``, ``h2``; repeated
    rows do no harm. Only rows of the universe that pass the first filter are
    shuffled, which are the listed ones and a ``share`` of the rest."""
    spark = listed.sparkSession
    inside = staged(listed.distinct(), "listed")
    n = inside.count()
    levels = [_build(inside, n, share, 0)]
    through = staged(_passing(spark, universe, levels[0], 0).distinct(), "through")
    over = staged(through.join(inside, "key", "left_anti"), "over")
    other = through.join(inside.select("key"), "key", "left_semi")  # listed keys that the corpus asks about
    while (m := over.count()) > 0:
        level = len(levels)
        levels.append(_build(over, m, 0.5, level))
        over, other = staged(_passing(spark, other, levels[-1], level), "over"), over
    return Cascade(levels)


def _passing(spark: SparkSession, keys: DataFrame, bloom: Bloom, level: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def holds(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(shared.value.holds(h1.to_numpy(np.int64).view(np.uint64), h2.to_numpy(np.int64).view(np.uint64), level))

    return keys.where(holds("h1", "h2"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", share: float = FALSE_SHARE,
                most_bytes: int = MOST_BYTES) -> DataFrame:
    """All columns of ``pages`` but the url's judged parts anew: ``host``,
    ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``verdict`` (allow or block), ``host`` and ``path``. A rule fits
    its host and all subdomains if the path starts with the rule's; the longest
    wins, of equally long ones that with the longer host, and of the same key
    listed under both verdicts, block. Rules with a NULL host or path, or an
    empty host, fit nothing. Urls that fit no rule get ``default``.

    A NULL url, or one without ``://``, has an empty host and path and fits no
    rule. Repeated rows are judged alike. Columns of ``pages`` named like the
    result are replaced.

    Filters of more than ``most_bytes`` are built and asked in parts, by the
    hash of the key; what the parts find is put together per row.
    """
    spark = pages.sparkSession
    rules = staged(rules.where("host <> '' and path is not null and verdict in ('allow', 'block')")
                   .select("verdict", "host", "path").distinct(), "rules")
    shapes = shapes_of(rules)
    judged = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = judged.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    h1, h2 = _hashes(F.col("key"))
    universe = judged.select(F.explode("_keys").alias("key")).withColumns({"h1": h1, "h2": h2})
    listed = rules.withColumn("key", F.concat("host", "path")).withColumns({"h1": h1, "h2": h2})
    size = rules.count() * max(1.0, -log(share) / log(2) ** 2 / 8) * 1.5
    parts = max(1, ceil(size / most_bytes))
    found = F.array_repeat(F.lit(0), F.size("_keys"))
    judged = judged.withColumn("_found", found)
    for part in range(parts):
        mine = F.pmod(F.col("h1"), F.lit(parts)) == part
        cascades = {v: build_cascade(listed.where((F.col("verdict") == v) & mine).select("key", "h1", "h2"),
                                     universe.where(mine), share) for v in ("allow", "block")}
        judged = judged.withColumn("_found", _asked(spark, cascades, parts, part)(
            F.transform("_keys", lambda k: _hashes(k)[0]), F.transform("_keys", lambda k: _hashes(k)[1]), "_found"))
    first = F.array_position(F.transform("_found", lambda v: v > 0), True)
    rule = F.when(first > 0, F.element_at("_keys", first.cast("int")))
    verdict = F.when(first > 0, F.when(F.element_at("_found", first.cast("int")) > 1, "block").otherwise("allow")).otherwise(F.lit(default))
    return judged.withColumns({"rule": rule, "verdict": verdict}).drop("_keys", "_found")


def _asked(spark: SparkSession, cascades: dict[str, Cascade], parts: int, part: int):
    """Marks keys of this part: 1 allowed, 2 blocked; other marks stay."""
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<int>")
    def ask(first: pd.Series, second: pd.Series, found: pd.Series) -> pd.Series:
        sizes = first.map(len).to_numpy(np.int64)
        flat = [np.concatenate([np.asarray(x) for x in c]) if sizes.sum() else np.zeros(0) for c in (first, second, found)]
        h1, h2 = (x.astype(np.int64).view(np.uint64) for x in flat[:2])
        marks = flat[2].astype(np.int32)
        at = np.flatnonzero((h1.view(np.int64) % parts) == part)
        for mark, verdict in ((1, "allow"), (2, "block")):
            marks[at[shared.value[verdict].lists(h1[at], h2[at])]] = mark
        return pd.Series(np.split(marks, np.cumsum(sizes)[:-1]) if len(sizes) else [], dtype=object)

    return ask
