"""Equal-count bins and calibration of scores.

With ``n`` values and ``k`` bins the value of rank ``r`` goes to bin
``floor((r-1)*k/n)``. Only ranks next to a bin boundary need their exact
value: a cell of the value range (see :mod:`barline.functions.order_stats`)
that lies inside one bin is aggregated as a whole, and only the few cells that
straddle a boundary are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import number
from barline.functions.order_stats import rank_first, rank_ties, split_cells
from barline.session import once, stack

NEG_INF = float("-inf")


def _check_bins(n_bins: int) -> int:
    if int(n_bins) <= 0:
        raise ValueError("n_bins must be positive")
    return int(n_bins)


def _tag_bins(df: DataFrame, value: str, tie: str, n_bins: int, keys: Sequence[str], n_cells: int | None
              ) -> DataFrame:
    """Rows with their equal-count ``bin``, ties in order of ``tie``."""
    cells = split_cells(df, value, tie, keys, n_cells)
    if cells.empty:
        raise ValueError("no values to make bins of")
    lo = F.expr(f"_ahead * {n_bins} div _total")
    hi = F.expr(f"(_ahead + _n - 1) * {n_bins} div _total")
    tagged = cells.tagged().withColumns({"_lo": lo, "_hi": hi})
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = tagged.where("_lo = _hi").select(*columns, F.col("_lo").cast("int").alias("bin"))
    inside = Window.partitionBy(*cells.keys, "_cell", "_sub").orderBy(value, tie)
    ranked = tagged.where("_lo < _hi").withColumn("_rank", F.col("_ahead") + F.row_number().over(inside))
    split = ranked.select(*columns, F.expr(f"(_rank - 1) * {n_bins} div _total").cast("int").alias("bin"))
    return stack(whole, split)


def equal_count_bins(df: DataFrame, value: str, tie: str, n_bins: int = 10, keys: Sequence[str] = (), *,
                     n_cells: int | None = None) -> DataFrame:
    """The bin table of a reference set: ``keys, bin, edge_lo, edge_hi, p_low,
    p_high, p_center, n``.

    Missing values are left out. Bins without rows (fewer values than bins)
    have count 0, the overall lowest low, and the high and center of the bin
    before. Bin ``i`` covers ``(edge_lo, edge_hi]``; the first edge is -inf.
    """
    n_bins, keys = _check_bins(n_bins), list(keys)
    clean = df.select(*keys, number(value).alias("v"), F.col(tie).alias("_tie")).where("v is not null")
    stats = _tag_bins(clean, "v", "_tie", n_bins, keys, n_cells).groupBy(*keys, "bin").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.avg("v").alias("center"), F.count(F.lit(1)).alias("c"))
    groups = stats.groupBy(*keys).agg(F.min("low").alias("_min"), F.count(F.lit(1)).alias("_found"))
    bins = groups.where("_found > 0").withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    w = Window.partitionBy(*keys).orderBy("bin")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        bins.join(stats, [*keys, "bin"], "left")
        .select(*keys, "bin",
                F.coalesce("low", "_min").alias("p_low"),
                F.max("high").over(upto).alias("p_high"),
                F.last("center", ignorenulls=True).over(upto).alias("p_center"),
                F.coalesce("c", F.lit(0)).alias("n"))
        .select(*keys, "bin", F.coalesce(F.lag("p_high").over(w), F.lit(NEG_INF)).alias("edge_lo"),
                F.col("p_high").alias("edge_hi"), "p_low", "p_high", "p_center", "n")
    )


def _edges(spec: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with the sorted upper edges (``n_bins`` numbers)."""
    pairs = F.array_sort(F.collect_list(F.struct("bin", "edge_hi")))
    return spec.groupBy(*keys).agg(F.transform(pairs, lambda p: p["edge_hi"]).alias("_edges"))


def bin_of(x: Column, edges: Column, policy: str = "clip") -> Column:
    """Bin of ``x`` given sorted upper edges; equal edges go to the lowest bin."""
    n = F.size(edges)
    raw = F.size(F.filter(edges, lambda e: e < x))
    missing = x.isNull() | F.isnan(x)
    below = x == NEG_INF
    if policy == "clip":
        return F.when(missing, -1).when(raw >= n, n - 1).otherwise(raw)
    if policy == "ignore":
        return F.when(missing | below | (raw >= n), -1).otherwise(raw)
    if policy == "error":
        bad = missing | below | (raw >= n)
        return F.when(bad, F.raise_error(F.lit("missing or out-of-range value in bin assignment")).cast("int")
                      ).otherwise(raw)
    raise ValueError(f"unknown out-of-range policy {policy!r}")


def assign_bins(df: DataFrame, value: str, spec: DataFrame, policy: str = "clip", keys: Sequence[str] = (), *,
                name: str = "bin") -> DataFrame:
    """Add the bin of ``value`` under ``spec``.

    ``clip``: above the last edge -> last bin, missing -> -1. ``ignore``: both
    -> -1. ``error``: fail. The edges are one small row per key; without keys
    that single row is broadcast.
    """
    keys = list(keys)
    edges = _edges(spec, keys)
    x = number(value)
    if keys:
        joined = df.join(edges, keys, "left")
    else:
        joined = df.withColumn("_one", F.lit(1)).join(F.broadcast(edges.withColumn("_one", F.lit(1))), "_one").drop("_one")
    return joined.withColumn(name, bin_of(x, F.col("_edges"), policy).cast("int")).drop("_edges")


def bins_left_join(spec: DataFrame, stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """All bins of ``spec`` with their stats; bins without rows have n = 0."""
    on = [*keys, "bin"]
    out = spec.select(*on, "p_low", "p_high", "p_center").join(stats, on, "left")
    return out.withColumn("n", F.coalesce("n", F.lit(0)))


def summarize_bins(df: DataFrame, value: str, y: str, spec: DataFrame, *, weight: str | None = None,
                   keys: Sequence[str] = (), value_stats: bool = True) -> DataFrame:
    """Per bin of ``spec``: rows, mean of ``y`` and weight sum.

    Rows outside the edges are dropped. With weights, rows without a weight are
    dropped and the mean is ``sum(w*y)/sum(w)``: NULL for a zero weight sum or
    when an outcome in the bin is missing.
    """
    keys = list(keys)
    tagged = assign_bins(df, value, spec, "ignore", keys).where("bin >= 0")
    y_col = number(y)
    if weight is None:
        stats = tagged.groupBy(*keys, "bin").agg(
            F.count(F.lit(1)).alias("n"), F.avg(y_col).alias("mean_y"),
            F.lit(None).cast("double").alias("w_sum"))
    else:
        w = number(weight)
        sums = tagged.where(w.isNotNull()).groupBy(*keys, "bin").agg(
            F.count(F.lit(1)).alias("n"), F.sum(w).alias("w_sum"),
            F.when(F.count(y_col) == F.count(F.lit(1)), F.sum(w * y_col)).alias("_wy"))
        stats = sums.select(*keys, "bin", "n", (F.col("_wy") / F.nullif("w_sum", F.lit(0.0))).alias("mean_y"), "w_sum")
    return bins_left_join(spec, stats, keys) if value_stats else stats


def rank_bins(df: DataFrame, value: str, tie: str, n_bins: int = 10, method: str = "first",
              keys: Sequence[str] = (), *, n_cells: int | None = None) -> DataFrame:
    """Add ``bin`` by rank within the data itself; missing values get -1.

    ``method`` is how equal values rank: ``first`` (in order of ``tie``),
    ``average``, ``min``, ``max`` or ``dense``. The row count includes rows
    with a missing value.
    """
    n_bins, keys = _check_bins(n_bins), list(keys)
    marked = once(df).withColumn("_v", number(value))
    present, absent = marked.where("_v is not null"), marked.where("_v is null")
    if method == "first":
        ranked = rank_first(present, "_v", tie, keys, name="_rank", n_cells=n_cells)
    else:
        ranked = rank_ties(present, "_v", method, keys, name="_rank", n_cells=n_cells)
    if keys:
        sized = ranked.join(marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all")), keys)
    else:
        total = marked.agg(F.count(F.lit(1)).alias("_all")).withColumn("_one", F.lit(1))
        sized = ranked.withColumn("_one", F.lit(1)).join(F.broadcast(total), "_one")
    spot = F.floor((F.col("_rank") - 1) * F.lit(n_bins) / F.col("_all"))
    bin_col = F.greatest(F.least(spot, F.lit(n_bins - 1)), F.lit(0)).cast("int")
    columns = [F.col(f"`{c}`") for c in df.columns]
    return stack(sized.select(*columns, bin_col.alias("bin")), absent.select(*columns, F.lit(-1).alias("bin")))


def calibration(df: DataFrame, value: str, y: str, tie: str, n_bins: int = 10, method: str = "first",
                keys: Sequence[str] = (), *, n_cells: int | None = None) -> DataFrame:
    """Calibration table: ``bin, mean_p, mean_y, n, p_low, p_high``.

    Rows missing the score or the outcome are dropped first. Sort by
    ``mean_p`` to show it.
    """
    n_bins, keys = _check_bins(n_bins), list(keys)
    clean = df.select(*keys, number(value).alias("p"), number(y).alias("y"), F.col(tie).alias("_tie")
                      ).dropna(subset=["p", "y"])
    if method == "first":
        tagged = _tag_bins(clean, "p", "_tie", n_bins, keys, n_cells)
    else:
        tagged = rank_bins(clean, "p", "_tie", n_bins, method, keys, n_cells=n_cells)
    return tagged.groupBy(*keys, "bin").agg(
        F.avg("p").alias("mean_p"), F.avg("y").alias("mean_y"), F.count(F.lit(1)).alias("n"),
        F.min("p").alias("p_low"), F.max("p").alias("p_high"))
