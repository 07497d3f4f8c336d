"""Toxicity by a weighted lexicon.

Texts are folded first: homoglyphs, accents and digits that stand for letters
become one form. Lexicon entries are words, or beginnings of words, with a
weight learned from labelled rows; an Aho-Corasick automaton finds the longest
entries in one pass. Entries that are phrases of weight 0 shield the words in
them. What was found, set against the length of the text, gives the score.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.store import staged

#: Labelled rows learned from, at most; those of least hash.
LABELLED = 50_000
#: Entries considered, at most: the most frequent of toxic texts.
CANDIDATES = 200_000
#: Toxic rows an entry must occur in, and how far its odds must lie from 1, in standard errors.
SUPPORT, ERRORS = 3, 3.5
#: Letters of the shortest and longest beginning of a word that is an entry.
SHORTEST, LONGEST = 5, 9
#: Rows of this remainder (of the CRC-32 of the id, by 4) are never learned from; those of
#: the others are measured, to fit the curve, with a lexicon of the two parts beside their own.
HELD_OUT, PARTS = 2, (0, 1, 3)
THRESHOLD = 0.3
#: Harmless phrases with words that insult elsewhere; learned ones are added.
EXCEPTIONS = ("trash can", "trash bag", "clown fish", "clown car", "pond scum", "scum line", "sore loser", "idiot proof", "oxy moron")

# Letters that look like a Latin one, and digits and signs written for letters.
LOOKALIKE = dict(zip("аеорсухіѕјԁһкмтвнɡαειορτυνκ", "aeopcyxisjdhkmtbhgaeioptuvk"))
FOR_LETTERS = dict(zip("0134578", "oleastb"))
FOLDED = {"i": "l", "ı": "l"}  # i, l and 1 are written for each other

_SIGN = re.compile(r"[@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def _table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for point in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        base = unicodedata.normalize("NFKD", chr(point))[0].lower()
        if base != chr(point):
            table[point] = base
    table |= dict.fromkeys((*range(0x300, 0x370), *range(0x200B, 0x200E), 0x2060, 0xFEFF, 0xAD))
    table |= {ord(a): b for a, b in (LOOKALIKE | FOR_LETTERS | FOLDED).items()}
    return {p: FOLDED.get(c, c) if c else c for p, c in table.items()}


TABLE = _table()


def words(text: str | None) -> list[str]:
    """The folded words of a text."""
    text = (text or "").lower()
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: "a" if m.group() == "@" else "s", text)
    return _WORD.findall(text.translate(TABLE))


def spaced(found: Sequence[str]) -> str:
    """Words as the automaton reads them: each with a space before and after."""
    return f" {'  '.join(found)} " if found else ""


def entries(word: str) -> Iterator[str]:
    """The entries a word supports: itself, and its beginnings."""
    yield f" {word} "
    for k in range(SHORTEST, min(len(word) - 1, LONGEST) + 1):
        yield f" {word[:k]}"


def automaton(weights: dict[str, float]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry, weight in weights.items():
        found.add_word(entry, weight)
    if weights:
        found.make_automaton()
    return found


def measures(text: str | None, lexicon) -> tuple[float, float, float, float]:
    """Strongest hit, sum of weights, sum by words and hits by words."""
    found = words(text)
    hits = [w for _, w in lexicon.iter_long(spaced(found))] if found and len(lexicon) else []
    hits = [w for w in hits if w > 0]
    if not hits:
        return 0.0, 0.0, 0.0, 0.0
    total = sum(hits)
    return max(hits), float(np.log1p(total)), float(np.log1p(100 * total / len(found))), float(np.sqrt(len(hits) / len(found)))


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Log of the odds ratio of rows with an entry, and its standard error."""
    a, b, c, d = toxic + 0.5, n_toxic - toxic + 0.5, clean + 0.5, n_clean - clean + 0.5
    return np.log(a * d / (b * c)), np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and slopes, by Newton's method."""
    x = np.column_stack((np.ones(len(x)), x))
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass(frozen=True)
class Toxicity:
    """What was learned: weights of the lexicon (0 for exception phrases) and
    the curve that makes measures a probability; no curve without both labels."""

    weights: dict[str, float]
    curve: tuple[float, ...] | None

    def scores(self, texts: Sequence[str | None], lexicon=None) -> np.ndarray:
        if self.curve is None:
            return np.zeros(len(texts))
        lexicon = automaton(self.weights) if lexicon is None else lexicon
        x = np.array([(1.0, *measures(t, lexicon)) for t in texts]).reshape(len(texts), -1)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.curve), -30, 30))) if len(x) else np.zeros(0)


def remainder(doc_id="doc_id"):
    """CRC-32 of the id as text, by 4; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def labelled_texts(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """``text``, ``toxic`` and ``part`` (remainder) of at most ``most`` labelled ids that may be learned from."""
    known = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")).withColumn("part", remainder())
    some = known.where(F.col("part") != HELD_OUT).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return staged(docs.select("doc_id", "text").join(some, "doc_id").select("text", "toxic", "part"), "labelled")


def _counted(rows: DataFrame, emit) -> DataFrame:
    """``entry`` and the rows it is in: clean and toxic (``n0`` and ``n1`` of the
    first part, and so on). ``emit`` makes the function that gives the distinct entries of a text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = emit()
        for batch in batches:
            counts: Counter = Counter()
            for text, toxic, part in zip(batch["text"], batch["toxic"], batch["part"]):
                kind = int(toxic) + 2 * PARTS.index(part)
                counts.update((entry, kind) for entry in made(text))
            yield pd.DataFrame([(e, k, n) for (e, k), n in counts.items()], columns=["entry", "kind", "n"])

    made = rows.mapInPandas(run, "entry string, kind int, n long")
    return made.groupBy("entry").agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(2 * len(PARTS))])


def _all_entries():
    def emit(text):
        return {e for w in set(words(text)) for e in entries(w)}

    return emit


def _among(known):
    def make():
        wanted = known.value

        def emit(text):
            return {e for w in set(words(text)) for e in entries(w) if e in wanted}

        return emit

    return make


def _near_hits(known):
    """Two-word phrases of which one word is a hit."""

    def make():
        lexicon = automaton(known.value)

        def emit(text):
            found = words(text)
            hit = {w for w in set(found) if any(True for _ in lexicon.iter_long(f" {w} "))} if len(lexicon) else set()
            return {f" {a}  {b} " for a, b in zip(found, found[1:]) if a in hit or b in hit}

        return emit

    return make


def _sums(counts: pd.DataFrame, parts: Sequence[int], kind: int) -> np.ndarray:
    return sum(counts[f"n{2 * p + kind}"].to_numpy(np.float64) for p in parts)


def _weights(counts: pd.DataFrame, sizes: np.ndarray, parts: Sequence[int]) -> dict[str, float]:
    """Entries whose odds in these parts are certain enough, with the log of their odds."""
    clean, toxic = _sums(counts, parts, 0), _sums(counts, parts, 1)
    ratio, error = log_odds(toxic, clean, *(sum(sizes[2 * p + kind] for p in parts) for kind in (1, 0)))
    sure = (toxic >= SUPPORT) & (ratio > ERRORS * error)
    return dict(zip(counts["entry"][sure], ratio[sure].tolist()))


def learn(docs: DataFrame, labels: DataFrame, most: int = LABELLED, exceptions: Sequence[str] = EXCEPTIONS) -> Toxicity:
    """The lexicon of all rows that may be learned from, and the curve, which is
    fitted on measures by lexicons that have not seen the row.
    At most CANDIDATES entries and ``most`` measures come to the driver."""
    spark, parts = docs.sparkSession, range(len(PARTS))
    rows = labelled_texts(docs, labels, most)
    sizes = np.zeros(2 * len(PARTS), np.int64)
    for r in rows.groupBy("toxic", "part").agg(F.count("*").alias("n")).collect():
        sizes[int(r["toxic"]) + 2 * PARTS.index(r["part"])] = r["n"]
    if not sizes[0::2].any() or not sizes[1::2].any():
        return Toxicity({}, None)
    frequent = _counted(rows.where("toxic"), _all_entries).select("entry", (F.col("n1") + F.col("n3") + F.col("n5")).alias("n"))
    frequent = frequent.where(f"n >= {SUPPORT}").orderBy(F.desc("n"), "entry").limit(CANDIDATES)
    wanted = frozenset(r["entry"] for r in frequent.select("entry").collect())
    counts = _counted(rows, _among(spark.sparkContext.broadcast(wanted))).toPandas()
    final = _weights(counts, sizes, parts)
    # phrases that are less likely in toxic texts than in others, although a word of theirs is not
    phrases = _counted(rows, _near_hits(spark.sparkContext.broadcast(final))).where(f"n0 + n2 + n4 >= {SUPPORT}")
    calm = phrases.orderBy(F.desc(F.col("n0") + F.col("n2") + F.col("n4")), "entry").limit(CANDIDATES).toPandas()
    ratio, error = log_odds(_sums(calm, parts, 1), _sums(calm, parts, 0), sizes[1::2].sum(), sizes[0::2].sum())
    shields = dict.fromkeys([*calm["entry"][ratio + error < 0], *(spaced(words(p)) for p in exceptions)], 0.0)
    unseen = [_weights(counts, sizes, [q for q in parts if q != p]) | shields for p in parts]
    shared = spark.sparkContext.broadcast(unseen)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicons = [automaton(w) for w in shared.value]
        for batch in batches:
            x = [measures(t, lexicons[PARTS.index(p)]) for t, p in zip(batch["text"], batch["part"])]
            yield pd.DataFrame(np.array(x).reshape(-1, 4), columns=list("abcd")).assign(y=batch["toxic"].to_numpy(bool).astype(float))

    got = rows.mapInPandas(run, "a double, b double, c double, d double, y double").toPandas()
    got = got.sort_values(list("abcdy"))  # sums must not depend on the order of rows
    return Toxicity(final | shields, tuple(fit_logistic(got[list("abcd")].to_numpy(), got["y"].to_numpy()).tolist()))


def toxicity(docs: DataFrame, labels: DataFrame, most: int = LABELLED, exceptions: Sequence[str] = EXCEPTIONS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; other columns are
    ignored): ``doc_id``, ``held_out``, ``score`` from 0 to 1 and ``predicted``.

    Learned from at most ``most`` ids of ``labels`` (``doc_id``, ``toxic``) that
    are not held out; of several labels of an id the largest counts, NULL ids and
    labels are passed over. Whole texts are read; NULL is empty, and an
    empty text gets the score of a text without a hit. Without a toxic and a
    clean row to learn from every score is 0. Equal texts have equal scores; a
    NULL id is not held out.
    """
    model = learn(docs, labels, most, exceptions)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = automaton(shared.value.weights)
        for batch in batches:
            score = shared.value.scores(list(batch["text"]), lexicon)
            yield batch[["doc_id", "held_out"]].assign(score=score, predicted=(score >= THRESHOLD).astype(np.int32))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(remainder() == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    made = rows.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int")
    return made.withColumn("doc_id", F.col("doc_id").cast(kind))
