"""Quality rules with thresholds that adapt to each language and source.

DataFrame functions only. Every text is measured; the measures of each (language,
source) are summed up in mergeable quantile sketches; fences beyond the quartiles
take the place of fixed cutoffs and are joined back to the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.store import staged

SPACE = " \t\n\u000b\u000c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Measure:
    """A share or mean per document; ``least_spread`` is the smallest quartile
    distance a fence counts with, so that a uniform source rejects nothing for
    a small deviation."""

    name: str
    least_spread: float
    low: bool = False


MEASURES = (
    Measure("symbol_share", 0.01), Measure("dup_line_share", 0.08), Measure("repeat_share", 0.05),
    Measure("upper_share", 0.03), Measure("mean_word", 0.5, low=True),
)
MEASURED = ("n_words", "n_repeat_words", "word_chars", "n_symbols", "n_dup_lines", *(m.name for m in MEASURES), "base_failed")
#: Fences stand so many quartile distances beyond the quartiles.
REACH = 6.0
#: Groups of fewer rows use their language's merged sketch, small languages that of all.
MIN_ROWS = 100
#: Size of a sketch; rank error is about 1.3 / K.
K = 400


def _n_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the measures, under the names of this module;
    columns of ``docs`` with such a name are replaced. NULL text has no words."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_t", t).withColumn("_w", F.filter(F.split("_t", SPACE_RUN), lambda w: w != ""))
    step = step.withColumn("n_words", F.size("_w").cast("long"))
    # three neighbouring words with their place; equal windows stand side by side once sorted
    n = F.size("_w")
    tail = lambda k: F.slice("_w", k, F.greatest(n, F.lit(1)))
    join = lambda a, b: F.concat(a, F.lit(" "), b)
    windows = F.slice(F.zip_with(F.zip_with("_w", tail(2), join), tail(3), join), 1, F.greatest(n - 2, F.lit(0)))
    step = step.withColumn("_s", F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    same = F.zip_with("_s", F.slice("_s", 2, F.greatest(F.size("_s"), F.lit(1))), lambda x, y: F.struct(
        x["i"].alias("i"), F.coalesce(x["w"] == y["w"], F.lit(False)).alias("next")))
    step = step.withColumn("_e", same)
    before = F.concat(F.array(F.lit(False)), F.transform("_e", lambda x: x["next"]))
    again = F.zip_with("_e", before, lambda x, last: F.when(x["next"] | last, x["i"]))
    step = step.withColumn("_p", F.sort_array(F.filter(again, lambda i: i.isNotNull())))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate("_p", start, lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))["n"]
    lines = F.filter(F.split("_t", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    step = step.withColumns({"n_repeat_words": covered, "_l": lines})
    step = step.withColumns({
        "word_chars": _n_without(F.col("_t"), SPACE).cast("long"),
        "n_symbols": (F.length("_t") - _n_without(F.col("_t"), SYMBOLS)).cast("long"),
        "_upper": F.length("_t") - _n_without(F.col("_t"), UPPER),
        "_lines": F.size("_l"), "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
    })
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    step = step.withColumns({
        "symbol_share": share("n_symbols", "word_chars"), "dup_line_share": share("n_dup_lines", "_lines"),
        "repeat_share": share("n_repeat_words", "n_words"), "upper_share": share("_upper", "word_chars"),
        "mean_word": share("word_chars", "n_words"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    })
    # filters on what a generator returns stay above it; pushed into the
    # expressions they would measure each text again for every condition
    others = [c for c in docs.columns if c not in MEASURED]
    return step.select(*others, F.inline(F.array(F.struct(*MEASURED))))


def fences(rows: DataFrame, reach: float = REACH, min_rows: int = MIN_ROWS) -> DataFrame:
    """``lang``, ``source`` and a struct ``fence`` of bounds per measure.

    Documents that fail the base rules don't shape the fences. Sketches are
    built map-side, so a source with a third of all rows costs no more than
    others; languages and the whole corpus merge the sketches of their groups.
    """
    good = rows.where(~F.col("base_failed"))
    sketch = [F.kll_sketch_agg_double(m.name, F.lit(K)).alias(m.name) for m in MEASURES]
    merge = [F.kll_merge_agg_double(m.name).alias(m.name) for m in MEASURES]
    group = staged(good.groupBy("lang", "source").agg(F.count("*").alias("n"), *sketch), "sketches")
    lang = group.groupBy("lang").agg(F.sum("n").alias("n"), *merge)
    whole = group.agg(F.sum("n").alias("n"), *merge).where("n > 0")  # a sketch of no rows has no quartiles
    ask = lambda df, *keys: df.select(*keys, "n", _bounds(reach).alias("fence"))
    g, x, all_ = ask(group, "lang", "source"), ask(lang, "lang").alias("x"), ask(whole).alias("all")
    g = g.alias("g").join(x, F.col("g.lang").eqNullSafe(F.col("x.lang")), "left").join(F.broadcast(all_), how="left")  # one row
    few = lambda a: F.col(f"{a}.n") < min_rows
    fence = F.when(~few("g"), F.col("g.fence")).when(~few("x"), F.col("x.fence")).otherwise(F.col("all.fence"))
    return g.select("g.lang", "g.source", fence.alias("fence"))


def _bounds(reach: float) -> Column:
    fields = []
    for m in MEASURES:
        low, high = (F.kll_sketch_get_quantile_double(m.name, F.lit(q)) for q in (0.25, 0.75))
        spread = F.greatest(high - low, F.lit(m.least_spread)) * reach
        fields += [(high + spread).alias(f"{m.name}_high")] + ([(low - spread).alias(f"{m.name}_low")] if m.low else [])
    return F.struct(*fields)


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept``: the base rules hold and no measure is beyond its fence. A
    group without fences (all its documents failed) keeps by the base rules."""
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fence")
    on = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    inside = F.lit(True)
    for m in MEASURES:
        inside &= F.col(m.name) <= F.col(f"fence.{m.name}_high")
        if m.low:
            inside &= F.col(m.name) >= F.col(f"fence.{m.name}_low")
    return (rows.join(limits, on, "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
            .drop("_lang", "_source", "fence"))


def quality_rules(docs: DataFrame, reach: float = REACH, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``lang``, ``source``;
    other columns are ignored): the measures, ``base_failed`` and ``kept``.

    NULL languages and sources are groups of their own. A NULL, empty or blank
    text has no words, fails the base rules and is not kept. Repeated rows are
    judged alike. Where no document passes the base rules there are no fences.
    """
    rows = staged(measured(docs.select("doc_id", "text", "lang", "source")).drop("text"), "measures")
    return judged(rows, staged(fences(rows, reach, min_rows), "fences")).drop("lang", "source")


def keep_good(docs: DataFrame, reach: float = REACH, min_rows: int = MIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with their columns."""
    whole = docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source")
    rows = staged(measured(whole).drop("text"), "measures")  # measuring costs far more than a copy of the rows
    return judged(rows, staged(fences(rows, reach, min_rows), "fences")).where("kept").select("_row.*")
