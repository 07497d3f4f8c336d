"""Running and neighbouring-row computations that no single task has to hold.

A window partitioned by series alone puts a whole series into one task, which
fails when one series holds a large share of the rows. Here a series is cut
into time chunks: each chunk is scanned on its own, and a small table with one
row per chunk carries totals and last values from chunk to chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barline.functions.columns import col, epoch_seconds
from barline.functions.order_stats import time_cells

DEFAULT_CHUNK_HOURS = 16_384
DEFAULT_BLOCK_ROWS = 8_192

CHUNK = "_chunk"
POSITION = "_pos"


def add_chunk(df: DataFrame, ts: str, chunk_hours: int | None = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """Add the chunk of a row. Chunks of fixed length suit bars, of which there
    is one per hour; ``None`` cuts by quantiles of the time instead (one small
    job now), for times that may crowd."""
    if chunk_hours is None:
        return time_cells(df, ts, CHUNK)
    step = int(chunk_hours) * 3600
    return df.withColumn(CHUNK, F.floor(epoch_seconds(ts) / step).cast("long"))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    nexts: Mapping[str, Column] | None = None,
    include_current: bool = True,
    chunk_hours: int | None = DEFAULT_CHUNK_HOURS,
) -> DataFrame:
    """Add running sums and nearest non-null values along ``order`` per ``keys``.

    ``sums[name]`` is the sum of the expression over all rows up to this one.
    ``lasts[name]`` is the newest non-null value of the expression up to this
    row (``include_current=False``: before it). ``nexts[name]`` is the oldest
    non-null value from this row on (or after it). ``order[0]`` is the time
    column; the rest break ties.

    One shuffle of the rows on (keys, chunk). The per-chunk table is aggregated
    map-side, and only that table is scanned per key.
    """
    sums, lasts, nexts = dict(sums or {}), dict(lasts or {}), dict(nexts or {})
    keys = list(keys)
    chunked = add_chunk(df, order[0], chunk_hours)
    order_cols = [F.col(c) for c in order]
    stamp = order_cols[0] if len(order) == 1 else F.struct(*order_cols)

    per_chunk = [F.sum(e).alias(f"_c_{n}") for n, e in sums.items()]
    per_chunk += [F.max_by(e, F.when(e.isNotNull(), stamp)).alias(f"_c_{n}") for n, e in lasts.items()]
    per_chunk += [F.min_by(e, F.when(e.isNotNull(), stamp)).alias(f"_c_{n}") for n, e in nexts.items()]
    chunks = chunked.groupBy(*keys, CHUNK).agg(*per_chunk)

    # Looking ahead is looking back in the opposite order: a frame that starts
    # at the current row would be added up anew for every row.
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(
        *keys, CHUNK,
        *[F.sum(f"_c_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_c_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
        *[F.last(f"_c_{n}", ignorenulls=True).over(after).alias(f"_c_{n}") for n in nexts],
    )

    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(*order_cols)
    through = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = Window.currentRow if include_current else -1
    back = in_chunk.rowsBetween(Window.unboundedPreceding, newest)
    ahead = (Window.partitionBy(*keys, CHUNK).orderBy(*[c.desc() for c in order_cols])
             .rowsBetween(Window.unboundedPreceding, newest))
    out = {}
    for n, e in sums.items():
        out[n] = F.coalesce(F.sum(e).over(through), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
    for n, e in lasts.items():
        out[n] = F.coalesce(F.last(e, ignorenulls=True).over(back), F.col(f"_c_{n}"))
    for n, e in nexts.items():
        out[n] = F.coalesce(F.last(e, ignorenulls=True).over(ahead), F.col(f"_c_{n}"))
    joined = chunked.join(carry, [*keys, CHUNK], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[e.alias(n) for n, e in out.items()])


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, name: str = POSITION,
              chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """Add the 0-based row position along ``order`` within ``keys``."""
    counted = running(df, keys, order, sums={name: F.lit(1)}, chunk_hours=chunk_hours)
    return counted.withColumn(name, F.col(name) - 1)


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    *,
    before: int = 0,
    after: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    chunk_hours: int = DEFAULT_CHUNK_HOURS,
) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back and
    ``after`` rows ahead.

    Rows are numbered within ``keys`` and cut into blocks of ``block_rows``;
    each block also gets the context rows its frames reach into. ``columns``
    receives the window ``(keys, block) order by position`` and returns the
    columns to add; it may use ``_pos`` and ``_offset``, the row's distance
    from where its block's context begins. Every task holds ``block_rows +
    before + after`` rows at most, whatever the size of a series.

    A frame that has ``_pos`` already (from :func:`positions`, no row removed
    since) is not numbered again, and keeps the column.
    """
    keys = list(keys)
    block_rows = max(int(block_rows), 4 * (before + after), 1)
    placed = df if POSITION in df.columns else positions(df, keys, order, chunk_hours=chunk_hours)
    position = F.col(POSITION)
    first = F.floor(F.greatest(position - after, F.lit(0)) / block_rows)
    last = F.floor((position + before) / block_rows)
    spread = (
        placed.withColumn("_home", F.floor(position / block_rows))
        .withColumn("_block", F.explode(F.sequence(first, last)))
        .withColumn("_offset", position - F.col("_block") * block_rows + before)
    )
    made = columns(Window.partitionBy(*keys, "_block").orderBy(POSITION))
    out = spread.select("*", *[e.alias(n) for n, e in made.items()]).where(F.col("_home") == F.col("_block"))
    return out.select(*[F.col(f"`{c}`") for c in [*df.columns, *made]])


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, Column | str],
             chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """Add values of the row just before (NULL values are kept as they are)."""
    wrapped = {n: F.struct(col(c).alias("v")) for n, c in columns.items()}
    out = running(df, keys, order, lasts=wrapped, include_current=False, chunk_hours=chunk_hours)
    return out.withColumns({n: F.col(f"{n}.v") for n in columns})
