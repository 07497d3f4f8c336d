"""Exact ranks and medians without sorting everything in one task.

Approximate quantiles give cut points, and the cut points give cells whose
order is known: every value in a cell is below every value in the next. A
value that holds many rows gets a cell of its own, cut again by the tie
column. Counting the cells then gives, for each, how many rows lie ahead of
it; only the rows inside a cell have to be sorted. The cut points affect the
sizes of the cells, never the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.session import once, stack

INF = float("inf")
# A value is cut by ties when it fills at least this many cells.
HEAVY_CELLS = 4
MAX_BROADCAST_CELLS = 200_000


@dataclass(frozen=True)
class Cells:
    """Rows tagged with their cell, and one table row per cell.

    ``rows`` has the input columns plus ``_cell`` and ``_sub``. ``table`` has
    the keys, ``_cell, _sub``, ``_n`` (rows in the cell), ``_ahead`` (rows of
    the same keys in earlier cells), ``_total`` (rows of the keys). Odd cells
    hold one single value.
    """

    rows: DataFrame
    table: DataFrame
    cuts: list[float]
    keys: list[str]
    value: str
    empty: bool
    max_cells: int

    def tagged(self) -> DataFrame:
        """Rows joined with their cell's counts.

        The table is broadcast where its size is bounded by the cell count and
        small; with keys it grows with them, and Spark decides.
        """
        small = not self.keys and self.max_cells <= MAX_BROADCAST_CELLS
        table = F.broadcast(self.table) if small else self.table
        return self.rows.join(table, [*self.keys, "_cell", "_sub"])


def default_cells(df: DataFrame) -> int:
    return 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _quantiles(df: DataFrame, column: str, n_cells: int) -> list[float] | None:
    """``n_cells - 1`` quantile estimates, None without rows: one pass, merged
    from partial sketches."""
    probs = [i / n_cells for i in range(1, n_cells)]
    row = df.agg(F.percentile_approx(column, probs, max(10_000, 20 * n_cells)).alias("q")).first()
    return None if row.q is None else [q for q in row.q if abs(q) != INF]


def _bucket(df: DataFrame, column: str, cuts: Sequence[float], out: str) -> DataFrame:
    """Add how many cuts are ``<= column``, by binary search in the JVM."""
    if not cuts:
        return df.withColumn(out, F.lit(0).cast("long"))
    splits = [-INF, *cuts, INF]
    placed = Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep").transform(df)
    return placed.withColumn(out, F.col(out).cast("long"))


def split_cells(df: DataFrame, value: str, tie: str | None = None, keys: Sequence[str] = (),
                n_cells: int | None = None) -> Cells:
    """Cut ``df`` into ordered cells. ``value`` must be a non-null double.

    An input that takes more than a scan is stored first, as all that follows
    reads it several times. With ``tie`` (a numeric column), values holding many
    rows are cut again by it. Runs one or two small aggregations now, to fetch at most ``n_cells``
    numbers each.
    """
    keys, df = list(keys), once(df)
    n_cells = max(2, n_cells or default_cells(df))
    found = _quantiles(df.select(value), value, n_cells)
    quantiles, heavy = found or [], []
    cuts = sorted(set(quantiles))
    rows = _bucket(df, value, cuts, "_cell")
    if not cuts:
        rows = rows.withColumn("_sub", F.lit(0).cast("long"))
    else:
        cut_at = F.element_at(F.array(*[F.lit(c) for c in cuts]), F.greatest(F.col("_cell"), F.lit(1)).cast("int"))
        at_cut = (F.col("_cell") > 0) & (F.col(value) == cut_at)
        rows = rows.withColumn("_cell", 2 * F.col("_cell") - at_cut.cast("long"))
        heavy = sorted(q for q, times in Counter(quantiles).items() if times >= HEAVY_CELLS)
        if tie is None or not heavy:
            rows = rows.withColumn("_sub", F.lit(0).cast("long"))
        else:
            ties = df.where(F.col(value).isin(heavy)).select(F.col(tie).cast("double").alias("_t"))
            tie_cuts = sorted(set(_quantiles(ties, "_t", n_cells) or []))
            rows = _bucket(rows.withColumn("_t", F.col(tie).cast("double")), "_t", tie_cuts, "_sub")
            rows = rows.withColumn("_sub", F.when(F.col(value).isin(heavy), F.col("_sub")).otherwise(0)).drop("_t")

    counts = rows.groupBy(*keys, "_cell", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    split = tie is not None and bool(heavy)
    cells = counts.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_n")) if split else counts
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    # At most 2 * n_cells rows per key go through this window.
    table = cells.withColumns({
        "_ahead": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
        "_total": F.sum("_n").over(Window.partitionBy(*keys)),
    })
    if split:
        inside = Window.partitionBy(*keys, "_cell").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
        table = counts.join(table.drop("_n"), [*keys, "_cell"]).withColumn(
            "_ahead", F.col("_ahead") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return Cells(rows, table, cuts, keys, value, found is None, (2 + len(heavy)) * n_cells)


def time_cells(df: DataFrame, ts: str, out: str, n_cells: int | None = None) -> DataFrame:
    """Add the cell of a time column: like time chunks, but cut so that each
    holds a like share of the rows, however they crowd in time."""
    placed = df.withColumn("_micros", F.unix_micros(F.col(ts).cast("timestamp")).cast("double"))
    cuts = _quantiles(placed, "_micros", max(2, n_cells or default_cells(df))) or []
    return _bucket(placed, "_micros", sorted(set(cuts)), out).drop("_micros")


def rank_first(df: DataFrame, value: str, tie: str, keys: Sequence[str] = (), *, name: str = "rank",
               n_cells: int | None = None) -> DataFrame:
    """Rank 1..n by ``value``, equal values in order of ``tie``."""
    cells = split_cells(df, value, tie, keys, n_cells)
    inside = Window.partitionBy(*cells.keys, "_cell", "_sub").orderBy(value, tie)
    ranked = cells.tagged().withColumn(name, F.col("_ahead") + F.row_number().over(inside))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], name)


def rank_ties(df: DataFrame, value: str, method: str, keys: Sequence[str] = (), *, name: str = "rank",
              n_cells: int | None = None) -> DataFrame:
    """Rank with equal values sharing one: ``average``, ``min``, ``max`` or ``dense``.

    Cells of a single value need no sorting at all, so a value that holds a
    third of the rows never meets in one task.
    """
    if method not in ("average", "min", "max", "dense"):
        raise ValueError(f"unknown tie method {method!r}")
    cells = split_cells(df, value, None, keys, n_cells)
    cell_keys = [*cells.keys, "_cell"]
    per_value = cells.rows.groupBy(*cell_keys, value).agg(F.count(F.lit(1)).alias("_same"))
    inside = Window.partitionBy(*cell_keys).orderBy(value)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    values = per_value.withColumns({
        "_less": F.coalesce(F.sum("_same").over(upto), F.lit(0)),
        "_order": F.row_number().over(inside),
    }).join(cells.table.drop("_sub"), cell_keys)
    if method == "dense":
        distinct = per_value.groupBy(*cell_keys).agg(F.count(F.lit(1)).alias("_d"))
        earlier = Window.partitionBy(*cells.keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        distinct = distinct.withColumn("_dbefore", F.coalesce(F.sum("_d").over(earlier), F.lit(0))).drop("_d")
        values = values.join(distinct, cell_keys)
        rank = F.col("_dbefore") + F.col("_order")
    else:
        low = F.col("_ahead") + F.col("_less") + 1
        high = F.col("_ahead") + F.col("_less") + F.col("_same")
        rank = {"min": low, "max": high, "average": (low + high) / 2.0}[method]
    values = values.select(*cell_keys, value, rank.cast("double").alias(name))
    # Values with many rows have a cell of their own. There are at most n_cells
    # of those (per key), so their ranks are broadcast where there are no keys.
    single = F.col("_cell") % 2 == 1
    hot_ranks = values.where(single).drop(value)
    if not cells.keys and cells.max_cells <= MAX_BROADCAST_CELLS:
        hot_ranks = F.broadcast(hot_ranks)
    hot = cells.rows.where(single).join(hot_ranks, cell_keys)
    rest = cells.rows.where(~single).join(values.where(~single), [*cell_keys, value])
    columns = [F.col(f"`{c}`") for c in df.columns]
    return stack(hot.select(*columns, name), rest.select(*columns, name))


def medians(df: DataFrame, value: str, keys: Sequence[str] = (), *, name: str = "median",
            n_cells: int | None = None) -> DataFrame:
    """Exact median of ``value`` per ``keys`` (one row without keys).

    Rows are counted per cell, and only the cells that hold a middle rank are
    looked into, with equal values counted together.
    """
    keys = list(keys)
    df = df.select(*keys, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull())
    cells = split_cells(df, value, None, keys, n_cells)
    middle = cells.table.withColumns({
        "_lo": F.floor((F.col("_total") + 1) / 2), "_hi": F.floor(F.col("_total") / 2) + 1,
    }).where((F.col("_ahead") < F.col("_hi")) & (F.col("_ahead") + F.col("_n") >= F.col("_lo"))).drop("_sub", "_n")
    if not keys:
        middle = F.broadcast(middle)
    inside = (
        cells.rows.join(middle, [*keys, "_cell"])
        .groupBy(*keys, "_cell", "_ahead", "_lo", "_hi", value).agg(F.count(F.lit(1)).alias("_same"))
    )
    through = (Window.partitionBy(*keys, "_cell").orderBy(value)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = inside.withColumn("_end", F.col("_ahead") + F.sum("_same").over(through))
    start = F.col("_end") - F.col("_same")
    low = F.max(F.when((start < F.col("_lo")) & (F.col("_end") >= F.col("_lo")), F.col(value)))
    high = F.max(F.when((start < F.col("_hi")) & (F.col("_end") >= F.col("_hi")), F.col(value)))
    return placed.groupBy(*keys).agg(((low + high) / 2.0).alias(name))
