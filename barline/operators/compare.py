"""Reconciling bars, features, lookbacks and scores between two sources.

How a value that only one side has counts differs by operator, and is stated
in each: a mismatch for feature maps, no mismatch for wide features and
tolerance checks of scores, a differing row for bars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import BAR_COLUMNS, finite, number
from barline.functions.order_stats import medians
from barline.functions.scans import DEFAULT_CHUNK_HOURS
from barline.operators.joins import SERIES_TS, nearest_ts
from barline.operators.series import obv
from barline.session import cut, stack

SCORE_KEY = ("series", "ts", "model_path")


def long_pairs(a: DataFrame, b: DataFrame, columns: Sequence[str], on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Inner join in long form: ``on, column, a, b, diff`` with ``diff = a - b``."""
    left = a.select(*on, F.array(*[number(F.col(f"`{c}`")) for c in columns]).alias("_a"))
    right = b.select(*on, F.array(*[number(F.col(f"`{c}`")) for c in columns]).alias("_b"))
    names = F.array(*[F.lit(c) for c in columns])
    joined = left.join(right, list(on))
    entries = F.arrays_zip(names.alias("column"), F.col("_a").alias("a"), F.col("_b").alias("b"))
    rows = joined.select(*on, F.explode(entries).alias("_e"))
    return rows.select(*on, "_e.column", "_e.a", "_e.b").withColumn("diff", F.col("a") - F.col("b"))


def _summary(pairs: DataFrame, counted: Column, measured: Column, keys: Sequence[str], largest: int = 0,
             on: Sequence[str] = ()) -> DataFrame:
    """Counts of ``counted`` rows and statistics of ``diff`` over ``measured``
    rows per key; the median is exact and found without a full sort. With
    ``largest``, the column ``largest`` lists the rows (``on``, ``a``, ``b``,
    ``diff``) of the largest absolute differences, equal ones in order of ``on``.

    All of it comes from one narrow table of the differences, stored first: the
    sources are joined a single time. Spark removes it with the result (see
    ``cleanCheckpoints`` in :func:`barline.session.build_session`).
    """
    keys, shown = list(keys), [*on, "a", "b"] if largest else []
    kept = cut(pairs.select(*dict.fromkeys([*keys, *shown, "diff"]), counted.alias("_counted"), measured.alias("_measured")))
    d = F.when(F.col("_measured"), F.col("diff"))
    stats = kept.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("_counted").alias("n_diff"), F.avg(d).alias("mean_diff"),
        F.min(d).alias("min_diff"), F.max(d).alias("max_diff"), F.stddev_pop(d).alias("std_diff"))
    more = [medians(kept.where("_measured").select(*keys, "diff"), "diff", keys, name="median_diff")]
    if largest:
        top = top_k_abs_diff(kept.where("_measured"), largest, keys, on)
        row = F.struct(F.negative("abs_diff").alias("_by"), *on, "a", "b", "diff")
        listed = F.transform(F.sort_array(F.collect_list(row)), lambda r: F.struct(*[r[c].alias(c) for c in [*on, "a", "b", "diff"]]))
        more.append(top.groupBy(*keys).agg(listed.alias("largest")))  # at most ``largest`` rows per key
    one = F.lit(1)
    for part in more:
        stats = (stats.join(part, keys, "left") if keys else
                 stats.withColumn("_k", one).join(part.withColumn("_k", one), "_k", "left").drop("_k"))
    return stats


def diff_stats_nonzero(pairs: DataFrame, keys: Sequence[str] = ("column",), largest: int = 0, on: Sequence[str] = ()) -> DataFrame:
    """Statistics over non-zero differences. A missing difference counts as
    differing and is left out of the statistics."""
    differs = F.col("diff").isNull() | (F.col("diff") != 0)
    return _summary(pairs, differs, F.coalesce(F.col("diff") != 0, F.lit(False)), keys, largest, on)


def diff_stats_all(pairs: DataFrame, keys: Sequence[str] = (), largest: int = 0, on: Sequence[str] = ()) -> DataFrame:
    """Statistics over all differences, and the number of non-zero ones."""
    differs = F.col("diff").isNull() | (F.col("diff") != 0)
    return _summary(pairs, differs, F.col("diff").isNotNull(), keys, largest, on)


def top_k_abs_diff(pairs: DataFrame, k: int = 5, keys: Sequence[str] = ("column",), tie: Sequence[str] = ("ts",)
                   ) -> DataFrame:
    """The ``k`` largest non-zero absolute differences per key.

    Spark keeps ``k`` rows per key and map task before it shuffles.
    """
    nonzero = pairs.where(F.col("diff") != 0).withColumn("abs_diff", F.abs("diff"))
    if not keys:
        return nonzero.orderBy(F.desc("abs_diff"), *tie).limit(k)
    order = Window.partitionBy(*keys).orderBy(F.desc("abs_diff"), *tie)
    return nonzero.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Differences that the comparisons list.
LARGEST = 5


def compare_bars(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS, largest: int = LARGEST) -> DataFrame:
    """Per bar column: joined rows, differing rows, statistics, largest differences."""
    return diff_stats_nonzero(long_pairs(a, b, BAR_COLUMNS, on), largest=largest, on=_time_first(on))


def _time_first(on: Sequence[str]) -> list[str]:
    return sorted(on, key=lambda c: c != "ts")


def score_pairs(a: DataFrame, b: DataFrame, on: Sequence[str] = SCORE_KEY) -> DataFrame:
    pairs = (a.select(*on, F.col("y_pred").alias("a")).join(b.select(*on, F.col("y_pred").alias("b")), list(on)))
    return pairs.withColumn("diff", F.col("a") - F.col("b"))


def compare_predictions(a: DataFrame, b: DataFrame, on: Sequence[str] = SCORE_KEY, largest: int = LARGEST, keys: Sequence[str] = ()
                        ) -> DataFrame:
    """Exact comparison of scores on common keys; in all or per ``keys``."""
    return diff_stats_all(score_pairs(a, b, on), keys, largest, _time_first(on))


def shared_features(a: DataFrame, b: DataFrame, on: Sequence[str]) -> list[str]:
    """Columns both sides have, without keys and without names starting with y."""
    return [c for c in a.columns if c in b.columns and c not in on and not c.lower().startswith("y")]


def compare_features_wide(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS, tol: float = 1e-9, largest: int = LARGEST
                          ) -> DataFrame:
    """Per shared column with mismatches: count and statistics over them.

    A mismatch is ``|a-b| > tol``; a value only one side has is none.
    """
    pairs = long_pairs(a, b, shared_features(a, b, on), on).where(F.abs("diff") > tol)
    return _summary(pairs, F.lit(True), F.lit(True), ["column"], largest, _time_first(on)).drop("n_rows")


def compare_maps(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS, tol: float = 1e-9) -> DataFrame:
    """Feature by feature over long rows ``on, name, value``.

    Status per name: ``missing_in_a``, ``missing_in_b``, ``mismatch`` (also when
    one side's value is missing), ``equal``; ``abs_diff`` where both have a
    value.
    """
    keys = [*on, "name"]
    left = a.select(*keys, F.col("value").alias("a"), F.lit(True).alias("_a"))
    right = b.select(*keys, F.col("value").alias("b"), F.lit(True).alias("_b"))
    gap = F.abs(F.col("a") - F.col("b"))
    one_missing = F.col("a").isNull() != F.col("b").isNull()
    status = (F.when(F.col("_b").isNull(), "missing_in_b").when(F.col("_a").isNull(), "missing_in_a")
              .when(one_missing | (gap > tol), "mismatch").otherwise("equal"))
    return (left.join(right, keys, "full_outer").withColumn("status", status).withColumn("abs_diff", gap)
            .drop("_a", "_b"))


def map_totals(compared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per status."""
    return compared.groupBy(*keys).agg(*[
        F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("missing_in_a", "missing_in_b", "mismatch", "equal")])


def compare_batch(a: DataFrame, b: DataFrame, targets: DataFrame, on: Sequence[str] = SERIES_TS, tol: float = 1e-9
                  ) -> DataFrame:
    """Per target: ``ok``, ``mismatch``, or ``skip`` when either side has no row.

    ``a`` and ``b`` are long feature rows; they are cut to the targets first.
    """
    wanted = targets.select(*on).distinct()
    left, right = (df.join(wanted, list(on), "left_semi") for df in (a, b))
    compared = compare_maps(left, right, on, tol)
    per_ts = compared.groupBy(*on).agg(
        F.count_if(F.col("status") != "equal").alias("n_bad"),
        F.count_if(F.col("status") != "missing_in_a").alias("_in_a"),
        F.count_if(F.col("status") != "missing_in_b").alias("_in_b"))
    verdict = (F.when(F.coalesce(F.col("_in_a"), F.lit(0)) == 0, "skip")
               .when(F.coalesce(F.col("_in_b"), F.lit(0)) == 0, "skip")
               .when(F.col("n_bad") > 0, "mismatch").otherwise("ok"))
    return wanted.join(per_ts, list(on), "left").select(
        *on, verdict.alias("verdict"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"))


def batch_totals(batch: DataFrame) -> DataFrame:
    """Compared, ok and failed targets; skipped ones count as failed."""
    return batch.agg(F.count(F.lit(1)).alias("compared"), F.count_if(F.col("verdict") == "ok").alias("ok"),
                     F.count_if(F.col("verdict") != "ok").alias("failed"))


LOOKBACK_KEY = ("series", "timeframe", "ts")


def compare_lookbacks(a: DataFrame, b: DataFrame, keys: Sequence[str] = LOOKBACK_KEY, tol: float = 1e-9) -> DataFrame:
    """Per lookback: row counts, whether the bar times agree, mismatches and
    largest difference per column over common bars, verdict.

    Equality is ``|a-b| <= tol``, or both missing.
    """
    on = [*keys, "bar_ts"]
    left = a.select(*on, *[F.col(c).alias(f"{c}_a") for c in BAR_COLUMNS], F.lit(True).alias("_a"))
    right = b.select(*on, *[F.col(c).alias(f"{c}_b") for c in BAR_COLUMNS], F.lit(True).alias("_b"))
    joined = left.join(right, on, "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()

    def differs(c: str) -> Column:
        x, y = F.col(f"{c}_a"), F.col(f"{c}_b")
        near = F.coalesce(F.abs(x - y) <= tol, F.lit(False)) | (x.isNull() & y.isNull())
        return both & ~near

    stats = joined.groupBy(*keys).agg(
        F.count("_a").alias("n_a"), F.count("_b").alias("n_b"), F.count_if(both).alias("n_common"),
        *[F.count_if(differs(c)).alias(f"mism_{c}") for c in BAR_COLUMNS],
        *[F.max(F.when(both, F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")))).alias(f"max_{c}") for c in BAR_COLUMNS])
    aligned = (F.col("n_a") == F.col("n_common")) & (F.col("n_b") == F.col("n_common"))
    clean = sum((F.col(f"mism_{c}") for c in BAR_COLUMNS), F.lit(0)) == 0
    return stats.withColumn("same_index", aligned).withColumn("ok", aligned & clean)


def frames_identical(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: do both frames have the same columns, types and rows (with
    multiplicity)? Rows are compared by count per distinct row."""
    if [(f.name, f.dataType) for f in a.schema] != [(f.name, f.dataType) for f in b.schema]:
        zero = a.sparkSession.range(1)
        return zero.select(F.lit(-1).cast("long").alias("n_different"), F.lit(False).alias("identical"))
    tagged = stack(a.withColumn("_side", F.lit(1)), b.withColumn("_side", F.lit(-1)))
    balance = tagged.groupBy(*a.columns).agg(F.sum("_side").alias("_d")).agg(
        F.coalesce(F.sum(F.abs("_d")), F.lit(0)).alias("n_different"))
    return balance.withColumn("identical", F.col("n_different") == 0)


def last_per_key(scores: DataFrame, on: Sequence[str], newest: str = "created_at") -> DataFrame:
    """One score per key, the newest."""
    w = Window.partitionBy(*on).orderBy(F.desc(newest), F.desc("y_pred"))
    return scores.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def compare_preds_tol(a: DataFrame, b: DataFrame, on: Sequence[str] = SCORE_KEY, tol: float = 1e-9) -> DataFrame:
    """Common keys and mismatches: both present and ``|a-b| > tol``. Of several
    scores of a key the newest counts."""
    pairs = score_pairs(last_per_key(a, on), last_per_key(b, on), on)
    return pairs.agg(F.count(F.lit(1)).alias("n_common"), F.count_if(F.abs("diff") > tol).alias("n_mismatch"))


def compare_preds_rel(reference: DataFrame, tested: DataFrame, on: Sequence[str] = SCORE_KEY, rel: float = 1e-3,
                      abs_tol: float = 1e-6, floor: float = 1e-10) -> DataFrame:
    """Mismatch where the reference score exceeds ``floor`` in size and the
    relative difference exceeds ``rel`` or the absolute one ``abs_tol``."""
    pairs = score_pairs(reference, tested, on)
    gap = F.abs("diff")
    sized = F.abs("a") > floor
    ratio = F.when(sized, gap / F.abs("a"))
    return pairs.agg(
        F.count(F.lit(1)).alias("n_common"), F.count_if(sized & ((ratio > rel) | (gap > abs_tol))).alias("n_mismatch"),
        F.coalesce(F.max(gap), F.lit(0.0)).alias("max_abs_diff"), F.coalesce(F.max(ratio), F.lit(0.0)).alias("max_rel_diff"))


def top_diff_features(a: DataFrame, b: DataFrame, k: int = 10, on: Sequence[str] = SERIES_TS) -> DataFrame:
    """The ``k`` features that differ most per bar, over long feature rows;
    zero and non-finite differences are left out."""
    keys = [*on, "name"]
    pairs = (a.select(*keys, F.col("value").alias("a")).join(b.select(*keys, F.col("value").alias("b")), keys)
             .withColumn("abs_diff", finite(F.abs(F.col("a") - F.col("b")))).where("abs_diff > 0"))
    w = Window.partitionBy(*on).orderBy(F.desc("abs_diff"), "name")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def explain_mismatch(sources: dict[str, DataFrame], generated: str, names: Sequence[str] = (),
                     on: Sequence[str] = SERIES_TS, tol: float = 1e-9, first: int | None = None) -> DataFrame:
    """Every source against ``generated``: differing features with a ``pair``
    column; with ``first``, so many names per pair and bar."""
    base = sources[generated]
    out = None
    for label, rows in sources.items():
        if label == generated:
            continue
        pair = compare_maps(_listed(rows, names), _listed(base, names), on, tol)
        pair = pair.where("status <> 'equal'").withColumn("pair", F.lit(f"{label}_vs_{generated}"))
        out = pair if out is None else stack(out, pair)
    if first is None:
        return out
    w = Window.partitionBy("pair", *on).orderBy("name")
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= first).drop("_rn")


def _listed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return rows.where(F.col("name").isin(list(names))) if names else rows


def spot_check(stored: DataFrame, recomputed: DataFrame, name: str, on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Stored minus recomputed value of one feature, over long feature rows.
    A recomputed value that is not finite counts as none."""
    a = stored.where(F.col("name") == name).select(*on, F.col("value").alias("stored"))
    b = recomputed.where(F.col("name") == name).select(*on, finite("value").alias("recomputed"))
    return a.join(b, list(on), "full_outer").withColumn("diff", F.col("stored") - F.col("recomputed"))


def compare_lookbacks_batch(stored: DataFrame, generated: DataFrame, continuous: DataFrame,
                            keys: Sequence[str] = ("series",), tol: float = 1e-9) -> DataFrame:
    """Verdict per target time and timeframe: ``ok``, ``diff``, ``missing`` (no
    stored lookback) or ``skipped`` (broken history).

    ``continuous`` has one row per target with the flag ``continuous``.
    """
    on = [*keys, "ts"]
    wanted = (generated.select(*on, "timeframe").distinct()
              .join(continuous.select(*on, "continuous"), on))
    compared = compare_lookbacks(stored, generated, [*keys, "timeframe", "ts"], tol).where("n_b > 0")
    joined = wanted.join(compared.select(*on, "timeframe", "n_a", "n_b", "ok"), [*on, "timeframe"], "left")
    verdict = (F.when(~F.col("continuous"), "skipped").when(F.coalesce("n_a", F.lit(0)) == 0, "missing")
               .when(F.col("ok"), "ok").otherwise("diff"))
    return joined.select(*on, "timeframe", F.coalesce("n_a", F.lit(0)).alias("n_stored"),
                         F.coalesce("n_b", F.lit(0)).alias("n_generated"), verdict.alias("verdict"))


def batch_verdict(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("verdict") == "ok").alias("n_ok"),
                       F.coalesce(F.every(F.col("verdict") == "ok"), F.lit(True)).alias("all_ok"))


def first_divergence(a: DataFrame, b: DataFrame, value: str, keys: Sequence[str] = ("series",), ts: str = "ts",
                     tol: float = 1e-6) -> DataFrame:
    """Per key, the first common time with ``|a-b| > tol`` and the row before.

    Two aggregations that combine map-side; no window over a whole series.
    """
    keys = list(keys)
    pairs = (a.select(*keys, ts, F.col(value).alias("a")).join(b.select(*keys, ts, F.col(value).alias("b")), [*keys, ts])
             .dropna(subset=["a", "b"]).withColumn("delta", F.col("a") - F.col("b")))
    row = F.struct("a", "b", "delta")
    first = (pairs.where(F.abs("delta") > tol).groupBy(*keys)
             .agg(F.min(ts).alias("first_ts"), F.min_by(row, ts).alias("_f")))
    earlier = (pairs.join(first.select(*keys, "first_ts"), keys).where(F.col(ts) < F.col("first_ts"))
               .groupBy(*keys).agg(F.max(ts).alias("prev_ts"), F.max_by(row, ts).alias("_p")))
    return first.join(earlier, keys, "left").select(
        *keys, "first_ts", F.col("_f.a").alias("a"), F.col("_f.b").alias("b"), F.col("_f.delta").alias("delta"),
        "prev_ts", F.col("_p.delta").alias("prev_delta"))


def obv_divergence(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("series",), tol: float = 1e-6,
                   chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """Where the volume balances of two bar sources part."""
    return first_divergence(obv(a, keys, chunk_hours), obv(b, keys, chunk_hours), "obv", keys, tol=tol)


def last_row_delta(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("series",), ts: str = "ts") -> DataFrame:
    """Bar columns of each side's own last row, A - B."""
    last = F.max_by(F.struct(*BAR_COLUMNS), ts)
    left = a.groupBy(*keys).agg(last.alias("_a"), F.max(ts).alias("last_a"))
    right = b.groupBy(*keys).agg(last.alias("_b"), F.max(ts).alias("last_b"))
    return left.join(right, list(keys)).select(
        *keys, "last_a", "last_b",
        *[(F.col(f"_a.{c}") - F.col(f"_b.{c}")).alias(f"delta_{c}") for c in BAR_COLUMNS])


def summary_columns(columns: Sequence[str]) -> list[str]:
    """Bar columns if there are any, else the first five."""
    return [c for c in BAR_COLUMNS if c in columns] or list(columns[:5])


def snapshot_summary(store: DataFrame, wanted: DataFrame, keys: Sequence[str] = ("series", "timeframe")) -> DataFrame:
    """One row per wanted ``(keys, ts)``: found or not, size, first and last
    bar, last row, and the nearest stored time where it is absent."""
    on = [*keys, "ts"]
    values = [c for c in store.columns if c not in (*on, "ts_key", "bar_ts")]
    shown = summary_columns(values)
    targets = wanted.select(*on).distinct()
    stats = store.join(targets, on, "left_semi").groupBy(*on).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("bar_ts").alias("first_bar"), F.max("bar_ts").alias("last_bar"),
        F.max_by(F.struct(*shown), "bar_ts").alias("_last"))
    nearest = nearest_ts(targets, store.select(*on).distinct(), keys)
    return (targets.join(stats, on, "left").join(nearest, on, "left")
            .select(*on, F.col("n_rows").isNotNull().alias("found"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                    F.lit(len(values)).alias("n_cols"), "first_bar", "last_bar",
                    *[F.col(f"_last.{c}").alias(f"last_{c}") for c in shown], "nearest_ts"))


def compare_score_sources(a: DataFrame, b: DataFrame, on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Largest absolute difference of two score columns on common keys."""
    return score_pairs(a, b, on).agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("diff")).alias("max_abs_diff"))


def wide_to_long(df: DataFrame, columns: Sequence[str], on: Sequence[str] = SERIES_TS) -> DataFrame:
    """Wide feature rows in long form."""
    entries = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]),
                                F.array(*[number(F.col(f"`{c}`")) for c in columns]))
    return df.select(*on, F.explode(entries).alias("name", "value"))
