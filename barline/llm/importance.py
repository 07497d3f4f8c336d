"""Quality by importance resampling of hashed n-grams.

Two bag-of-n-grams models are counted: of all texts, and of the texts labelled
good. The log of their ratio is a document's importance weight; Gumbel noise
makes the k largest noisy weights a sample drawn without replacement.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.ragged import chunks, code_points, mix, word_hashes, word_spans
from barline.llm.store import Carried, staged

BUCKETS = 1 << 14
#: Languages are told apart by a hash into so many slots; each has models of its
#: own, so that a sample with other shares of languages shifts no weight.
SLOTS = 32
SIZE = BUCKETS * SLOTS
GRAM = 3
#: Pseudo-counts that draw the ratio of a rare bucket to 1.
SMOOTHING = 30.0
#: Labelled rows used for the model of good text, at most; those of least hash.
LABELLED = 50_000
SEED = 1
#: Weights are added as integers of this unit, so that sums don't depend on order.
UNIT = 1e-6
_CHUNK = 400_000


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every n-gram: characters by three, and words by one and
    by two. A word after itself is one n-gram, whatever the word."""
    points, at = code_points(texts, gap=GRAM)
    p = points.astype(np.uint64)
    n = len(points) - GRAM + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x100000001B3) + p[k:k + n]
    owner = np.repeat(np.arange(len(texts)), np.diff(at))[:max(n, 0)]
    inside = np.arange(len(h)) <= at[1:][owner] - 2 * GRAM if len(h) else np.zeros(0, bool)
    starts, ends = word_spans(points)
    words = word_hashes(points, starts, ends)
    text = np.searchsorted(at, starts, side="right") - 1
    pair = text[1:] == text[:-1]
    two = np.where(words[1:] == words[:-1], np.uint64(1), words[:-1] * np.uint64(0x100000001B3) + words[1:])[pair]
    bucket = np.concatenate((mix(h[inside]), mix(words + np.uint64(2)), mix(two + np.uint64(3)))) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.concatenate((owner[inside], text, text[1:][pair]))


#: Stands for the id of rows without one; ``known`` tells them from a row that has it.
NO_ID = -1


def _id(docs: DataFrame):
    """The id as a whole number: itself, or the hash of an id of another type."""
    whole = docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(F.col("doc_id").cast("long") if whole else F.xxhash64("doc_id"), F.lit(NO_ID))


def _inputs(docs: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    slot = F.pmod(F.xxhash64(docs["lang"]), F.lit(SLOTS)) if "lang" in docs.columns else F.lit(0)
    return docs.select(_id(docs).alias("id"), F.col("doc_id").isNotNull().alias("known"), docs["text"].alias("t"),
                       slot.cast("long").alias("slot"), *also)


def model_counts(docs: DataFrame, good: np.ndarray) -> DataFrame:
    """``bucket``, ``raw`` and ``target`` counts over all texts; ``good`` holds
    the ids of the target as whole numbers, ascending. Each task sends at most SIZE rows."""
    shared = docs.sparkSession.sparkContext.broadcast(good)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, ids = np.zeros((2, SIZE), np.int64), shared.value
        for rows in batches:
            texts = [t or "" for t in rows["t"]]
            slots = rows["slot"].to_numpy()
            target = np.isin(rows["id"].to_numpy(), ids) & rows["known"].to_numpy()
            for a, b in chunks(texts, _CHUNK):
                bucket, text = ngrams(texts[a:b])
                bucket += slots[a:b][text] * BUCKETS
                counts[0] += np.bincount(bucket, minlength=SIZE)
                counts[1] += np.bincount(bucket[target[a:b][text]], minlength=SIZE)
        some = np.flatnonzero(counts[0])
        yield pd.DataFrame({"bucket": some, "raw": counts[0][some], "target": counts[1][some]})

    made = _inputs(docs).mapInPandas(run, "bucket long, raw long, target long")
    return made.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """Log of target over raw probability per bucket, in units of UNIT. At most
    SIZE rows come to the driver."""
    rows = counts.toPandas()
    table = np.zeros((2, SIZE))
    table[:, rows["bucket"].to_numpy(np.int64)] = rows["raw"], rows["target"]
    raw, target = table.reshape(2, SLOTS, BUCKETS)
    share = target.sum(axis=1) / np.maximum(raw.sum(axis=1), 1)
    ratio = np.log(target + SMOOTHING) - np.log(raw * share[:, None] + SMOOTHING)
    return np.rint(ratio.ravel() / UNIT).astype(np.int32)


def weights(texts: list[str], slots: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The log importance weight of each text."""
    out = np.zeros(len(texts))
    for a, b in chunks(texts, _CHUNK):
        bucket, text = ngrams(texts[a:b])
        bucket += slots[a:b][text] * BUCKETS
        # sums of integers below 2**53 are exact in doubles
        out[a:b] = np.rint(np.bincount(text, ratios[bucket], b - a)) * UNIT
    return out


def noisy(weight: np.ndarray, ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Weights with Gumbel noise that a document's id decides."""
    h = mix(mix(ids.astype(np.uint64)) + np.uint64(seed))
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    return weight - np.log(-np.log(u))


def labelled_good(labels: DataFrame, most: int = LABELLED) -> tuple[np.ndarray, float]:
    """Ids (as whole numbers) of good documents among at most ``most`` labelled ones, and the
    share of good documents among all labels."""
    known = labels.where("doc_id is not null and quality is not null")
    share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).where("quality = 1")
    ids = sample.select(_id(labels).alias("id")).toPandas()
    return np.unique(ids["id"].to_numpy(np.int64)), 0.5 if share is None else float(share)


def nth_largest(rows: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a column without NaN, exactly: its bits are
    found 16 at a time by counting, so at most 65,536 counts come to the driver."""
    if k <= 0:
        return None
    bits = F.col("_bits")
    known = rows.select(F.col(column).alias("_bits"))
    prefix = 0
    for shift in (48, 32, 16, 0):
        inside = known if shift == 48 else known.where(F.shiftright(bits, shift + 16) == prefix)
        part = F.shiftright(bits, shift)
        counts = sorted(((r["p"], r["n"]) for r in inside.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()), reverse=True)
        for p, n in counts:
            if k <= n:
                prefix = p
                break
            k -= n
        else:
            return None
    return prefix


def sortable(x: np.ndarray) -> np.ndarray:
    """Doubles as integers of the same order."""
    bits = np.ascontiguousarray(x + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def _fit(docs: DataFrame, labels: DataFrame, k: int | None, seed: int, most: int):
    good, share = labelled_good(labels, most)
    ratios = log_ratios(model_counts(docs, good))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            weight = weights([t or "" for t in rows["t"]], rows["slot"].to_numpy(), shared.value)
            key = noisy(weight, rows["id"].to_numpy(), seed)
            yield rows[kept].assign(log_weight=weight, sample_key=key, _order=sortable(key))

    carried = Carried(docs, ["doc_id"])
    kept = carried.held
    made = _inputs(docs.withColumn(kept[0], carried.columns[0]), kept).mapInPandas(
        run, carried.ddl + ", log_weight double, sample_key double, _order long")
    scored = staged(carried.back(made), "weights")
    if k is None:  # as many as are more likely good than not
        floor = float(np.log(0.5 / share)) if share else float("inf")
        k = scored.where(F.col("log_weight") >= floor).count()
    return scored, shared, nth_largest(scored, "_order", k) if k < scored.count() else -(1 << 63)


def importance_sample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED,
                      most: int = LABELLED) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text`` and, if there, ``lang``;
    other columns are ignored): ``log_weight``, ``sample_key`` (with Gumbel noise) and ``kept``.

    The ``k`` rows of largest key are kept; rows with the k-th key stay together.
    Without ``k`` as many are kept as have an estimated probability of at least
    one half of being good. The raw model counts every text; the target model
    the good texts among at most ``most`` labelled rows. A NULL text is empty
    and has the weight 0. Without labels every weight is that of smoothing alone.
    """
    scored, _, least = _fit(docs, labels, k, seed, most)
    kept = F.col("_order") >= least if least is not None else F.lit(False)
    return scored.withColumn("kept", kept).drop("_order")


def keep_sample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED,
                most: int = LABELLED) -> DataFrame:
    """The rows of ``docs`` that :func:`importance_sample` keeps, with their columns."""
    _, shared, least = _fit(docs, labels, k, seed, most)
    if least is None:
        return docs.limit(0)
    slot = F.pmod(F.xxhash64("lang"), F.lit(SLOTS)) if "lang" in docs.columns else F.lit(0)

    @F.pandas_udf("boolean")
    def drawn(ids: pd.Series, texts: pd.Series, slots: pd.Series) -> pd.Series:
        weight = weights([t or "" for t in texts], slots.to_numpy(), shared.value)
        return pd.Series(sortable(noisy(weight, ids.to_numpy(), seed)) >= least)

    return docs.where(drawn(_id(docs), "text", slot.cast("long")))
