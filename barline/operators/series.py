"""Bars as time series: resampling, labels, volume balance, lookbacks, continuity."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.functions.columns import (
    BAR_COLUMNS, TIMEFRAME_HOURS, epoch_seconds, floor_hour, floor_timeframe, hours, naive_utc, number, ts_key,
)
from barline.functions.scans import CHUNK, DEFAULT_BLOCK_ROWS, DEFAULT_CHUNK_HOURS, POSITION, add_chunk, over_rows, positions, running
from barline.operators.targets import Stamp
from barline.session import stack
from barline.sources.tables import in_range


def ticks_to_bars(ticks: DataFrame, *, series: str = "series", ts: str = "ts", value: str = "value",
                  order: Sequence[str] = ("ts",), timeframe_hours: int = 1) -> DataFrame:
    """Bars from single values; volume is the sum of the values.

    ``order`` decides which tick is first and last: name a second column when
    several ticks may share one time.
    """
    stamp = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    return (
        ticks.groupBy(F.col(series).alias("series"), floor_timeframe(ts, timeframe_hours).alias("ts"))
        .agg(F.min_by(value, stamp).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
             F.max_by(value, stamp).alias("close"), F.sum(value).alias("volume"))
    )


def longer_bars(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per longer bar (column ``bar_ts``), combined map-side first."""
    return placed.groupBy(*keys, "bar_ts").agg(
        F.min_by("open", "ts").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume"))


def resample_bars(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Bars of a longer timeframe, labelled by their start; a last bar that is
    not full yet is kept."""
    placed = bars.withColumn("bar_ts", floor_timeframe("ts", TIMEFRAME_HOURS[timeframe]))
    return longer_bars(placed, keys).withColumnRenamed("bar_ts", "ts")


def target_name(horizon: int, log: bool = True, label: str | None = None) -> str:
    return f"{'y_logret' if log else 'y_ret'}_{label or f'{horizon}h'}"


def forward_return(bars: DataFrame, horizon: int, *, log: bool = True, min_forward: int | None = None,
                   keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS,
                   block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Return from a bar's close to the close of the last of its next
    ``horizon`` bars (by row, so gaps are stepped over).

    Bars without a close, or with fewer than ``min_forward`` bars after them
    (default ``horizon``), give no row, nor does an undefined return.
    """
    if horizon <= 0:
        raise ValueError("horizon must be positive")
    keys, need = list(keys), min(min_forward or horizon, horizon)
    slim = bars.select(*keys, "ts", number("close").alias("close"))

    def forward(w):
        return {"_end": F.lead("close", horizon).over(w), "_there": F.lead(F.lit(True), horizon).over(w)}

    placed = positions(slim, keys, ["ts"], chunk_hours=chunk_hours)
    seen = over_rows(placed, keys, ["ts"], forward, after=horizon, chunk_hours=chunk_hours, block_rows=block_rows)
    if need < horizon:  # towards the end of a series its last bar stands in
        ends = slim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"), F.max_by("close", "ts").alias("_last"))
        seen = seen.join(ends, keys).withColumns({
            "_end": F.when(F.col("_there"), F.col("_end")).otherwise(F.col("_last")),
            "_there": F.col("_total") - 1 - F.col(POSITION) >= need})
    ratio = F.col("_end") / F.nullif(F.col("close"), F.lit(0.0))
    value = F.ln(ratio) if log else ratio - 1
    return seen.where("close is not null and _there").select(*keys, "ts", value.alias("y_true")).where("y_true is not null")


class NoTargets(ValueError):
    """Nothing to make labels of."""


def label_range(bars: DataFrame, start: Stamp, end: Stamp | None, horizon: int) -> DataFrame:
    """The bars that labels of ``[start, end]`` may look at: up to ``horizon``
    hours past the end (or all that are stored)."""
    last = None if end is None else naive_utc(end) + pd.Timedelta(hours=horizon)
    return in_range(bars, "ts", start, last)


def generate_targets(bars: DataFrame, *, start: Stamp, end: Stamp | None = None, horizon: int = 168,
                     log: bool = True, min_forward: int | None = None, label: str | None = None,
                     name: str | None = None, feature_key: str | None = None, keys: Sequence[str] = ("series",),
                     on_empty: str = "keep") -> DataFrame:
    """Label rows for the entry bars in ``[start, end]``.

    With ``on_empty="fail"`` no bars to look at, no entry bars and no labels are
    errors, told apart (up to three small jobs now).
    """
    if on_empty not in ("keep", "fail"):
        raise ValueError(f"unknown on_empty {on_empty!r}")
    scanned = label_range(bars, start, end, horizon)
    if on_empty == "fail":
        if scanned.isEmpty():
            raise NoTargets(f"no bars from {start} on; check the table and the range")
        if in_range(scanned, "ts", start, end).isEmpty():
            raise NoTargets(f"no bars from {start} to {end}")
    returns = in_range(forward_return(scanned, horizon, log=log, min_forward=min_forward, keys=keys), "ts", start, end)
    made = returns.select(
        *keys, F.col("ts").alias("timestamp"), F.lit(name or target_name(horizon, log, label)).alias("target_name"),
        "y_true", F.lit(horizon).alias("horizon_bars"), F.lit(label or f"{horizon}h").alias("target_label"),
        F.lit(feature_key).cast("string").alias("feature_key"))
    if on_empty == "fail" and made.isEmpty():
        raise NoTargets("no labels; check what the bars cover, and the horizon")
    return made


def obv(bars: DataFrame, keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """On-balance volume as ``keys, ts, obv``: start at 0, add the volume when
    the close rises, subtract it when it falls. A missing close on either side
    changes nothing, a missing volume counts as 0.

    A scan over segments: each time chunk is added up by itself, without the step
    into it; one row per chunk (its ends and its sum) tells that step and what
    lies before. The rows are read and shuffled once for both.
    """
    keys = list(keys)
    slim = add_chunk(bars.select(*keys, "ts", number("close").alias("_close"), F.coalesce(number("volume"), F.lit(0.0)).alias("_vol")),
                     "ts", chunk_hours)

    def signed(now: Column, before: Column, volume: Column) -> Column:
        return F.coalesce(F.signum(now - before) * volume, F.lit(0.0))

    along = Window.partitionBy(*keys, CHUNK).orderBy("ts")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = slim.withColumns({"_step": signed(F.col("_close"), F.lag("_close").over(along), F.col("_vol")), "_row": F.row_number().over(along)})
    inner = stepped.select(
        *keys, CHUNK, "ts", "_row", F.sum("_step").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_inner"),
        F.sum("_step").over(whole).alias("_sum"), F.first("_close").over(whole).alias("_first"), F.first("_vol").over(whole).alias("_first_vol"),
        F.last("_close").over(whole).alias("_last"))
    by_chunk = Window.partitionBy(*keys).orderBy(CHUNK)
    chunks = inner.where("_row = 1").withColumn("_into", signed(F.col("_first"), F.lag("_last").over(by_chunk), F.col("_first_vol")))
    earlier = F.sum(F.col("_sum") + F.col("_into")).over(by_chunk.rowsBetween(Window.unboundedPreceding, -1))
    carry = chunks.select(*keys, CHUNK, (F.coalesce(earlier, F.lit(0.0)) + F.col("_into")).alias("_before"))
    return inner.select(*keys, CHUNK, "ts", "_inner").join(carry, [*keys, CHUNK]).select(*keys, "ts", (F.col("_inner") + F.col("_before")).alias("obv"))


def reached(bars: DataFrame, targets: DataFrame, reach_hours: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """The bars that the ``reach_hours`` up to some target can touch, and no
    more than as many again.

    The scan is bounded by the first and last target (one row comes to the
    driver). Each target then names the two or three cells of ``reach_hours``
    that its interval meets; bars of other cells and series are passed over by
    an equi-join, so intervals that overlap are read once.
    """
    span = targets.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if span.lo is None:
        return bars.where(F.lit(False))
    step = max(1, reach_hours) * 3600
    seconds = epoch_seconds("ts")
    cells = F.sequence(F.floor((seconds - reach_hours * 3600) / step), F.floor(seconds / step))
    met = targets.select(*keys, F.explode(cells).alias("_cell")).distinct()
    near = in_range(bars, "ts", pd.Timestamp(span.lo) - pd.Timedelta(hours=reach_hours), span.hi)
    return near.withColumn("_cell", F.floor(seconds / step)).join(met, [*keys, "_cell"], "left_semi").drop("_cell")


def by_timeframe(bars: DataFrame, timeframes: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Each bar once per timeframe, with the start of the longer bar it is in."""
    places = F.array(*[F.struct(F.lit(tf).alias("timeframe"), floor_timeframe("ts", TIMEFRAME_HOURS[tf]).alias("bar_ts"))
                       for tf in timeframes])
    slim = bars.select(*keys, "ts", *BAR_COLUMNS, F.explode(places).alias("_p"))
    return slim.select(*keys, "_p.timeframe", "ts", "_p.bar_ts", *BAR_COLUMNS)


def _so_far(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The longer bar of each row as known at the row's time. Groups hold the
    rows of one longer bar."""
    w = Window.partitionBy(*keys, "bar_ts").orderBy("ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select(
        *keys, "ts", "bar_ts", F.first("open").over(w).alias("open"), F.max("high").over(w).alias("high"),
        F.min("low").over(w).alias("low"), "close", F.sum("volume").over(w).alias("volume"))


def bars_so_far(placed: DataFrame, keys: Sequence[str], targets: DataFrame) -> DataFrame:
    """The longer bars that the targets (``ts`` and the keys they share) are in,
    as known at their time. Only the longer bars of some target are put in order."""
    on = [k for k in keys if k in targets.columns]
    asked = placed.join(targets.select(*on, "ts").distinct(), [*on, "ts"], "left_semi").select(*keys, "bar_ts").distinct()
    some = placed.join(asked, [*keys, "bar_ts"], "left_semi")
    return _so_far(some, keys).join(targets.select(*on, "ts").distinct(), [*on, "ts"], "left_semi")


def partial_bars(bars: DataFrame, timeframe: str, keys: Sequence[str] = ("series",)) -> DataFrame:
    """For every bar, the longer bar it falls in as known at that time:
    ``keys, ts, bar_ts, open..volume``."""
    step = TIMEFRAME_HOURS[timeframe]
    slim = bars.select(*keys, "ts", *BAR_COLUMNS)
    if step == 1:
        return slim.select(*keys, "ts", F.col("ts").alias("bar_ts"), *BAR_COLUMNS)
    return _so_far(slim.withColumn("bar_ts", floor_timeframe("ts", step)), keys)


def lookback(bars: DataFrame, targets: DataFrame, window_hours: int = 720,
             timeframes: Sequence[str] = tuple(TIMEFRAME_HOURS), keys: Sequence[str] = ("series",),
             chunk_hours: int = DEFAULT_CHUNK_HOURS, reach_hours: int | None = None) -> DataFrame:
    """The trailing ``window_hours / timeframe`` bars of each target time, the
    last of them only as far as the target itself.

    With ``reach_hours`` only bars of that many hours up to a target are read
    for it (longer bars begin with the first whole one), so a series with gaps may have
    fewer of them; without, gaps are made up for from further back, which reads whole series.

    Long form: ``keys, timeframe, ts_key, ts, bar_ts, open..volume``. All
    timeframes go through one plan. Bars are numbered per series and timeframe;
    a bar joins the targets of its own and the next block of positions, so the
    rows a join looks at are at most twice its output.
    """
    keys = list(keys)
    frame_keys = [*keys, "timeframe"]
    sizes = {tf: max(1, window_hours // TIMEFRAME_HOURS[tf]) for tf in timeframes}
    n = F.element_at(F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv]), F.col("timeframe"))
    if reach_hours is not None:
        bars = reached(bars, targets, reach_hours, keys)
    placed = by_timeframe(bars, timeframes, keys)
    full = positions(longer_bars(placed, frame_keys), frame_keys, ["bar_ts"], chunk_hours=chunk_hours)
    wanted = targets.select(*keys, "ts").distinct()
    current = _so_far(placed, frame_keys).join(wanted, [*keys, "ts"], "left_semi")
    ends = current.join(full.select(*frame_keys, "bar_ts", F.col("_pos").alias("_end")), [*frame_keys, "bar_ts"])
    block = F.floor(F.col("_pos") / n)
    blocks = full.withColumn("_block", F.explode(F.array(block, block + 1)))
    earlier = (
        ends.select(*frame_keys, "ts", "_end", F.floor(F.col("_end") / n).alias("_block"))
        .join(blocks, [*frame_keys, "_block"])
        .where((F.col("_pos") < F.col("_end")) & (F.col("_pos") > F.col("_end") - n))
    )
    if reach_hours is not None:
        earlier = earlier.where(F.col("bar_ts") >= F.col("ts") - hours(reach_hours))
    columns = [*frame_keys, "ts", "bar_ts", *BAR_COLUMNS]
    rows = stack(earlier.select(*columns), ends.select(*columns))
    return rows.select(*frame_keys, ts_key("ts").alias("ts_key"), "ts", "bar_ts", *BAR_COLUMNS)


def trim_lookback(store: DataFrame, base_hours: int = 720) -> DataFrame:
    """Cut lookbacks to the newest ``base_hours`` of each target."""
    label = _last_label()
    age = (epoch_seconds(label) - epoch_seconds("bar_ts")) / 3600
    return store.where(age < base_hours)


def _timeframe_hours() -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in TIMEFRAME_HOURS.items() for x in kv]), F.col("timeframe"))


def _last_label() -> Column:
    """Start of the target's own bar in the row's timeframe."""
    step = _timeframe_hours() * 3600
    return F.timestamp_seconds(F.floor(epoch_seconds("ts") / step) * step).cast("timestamp_ntz")


def validate_exact(store: DataFrame, base_hours: int = 720, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Per lookback: rows, expected rows, and whether count and end are exact."""
    step, label = _timeframe_hours(), _last_label()
    checked = store.groupBy(*keys, "timeframe", "ts").agg(
        F.count(F.lit(1)).alias("n"), F.max("bar_ts").alias("last_bar"))
    expected = F.floor(F.lit(base_hours) / step)
    exact = (F.col("n") == expected) & (F.col("last_bar") == label)
    return checked.withColumns({"expected": expected, "exact": exact})


def continuity(bars: DataFrame, targets: DataFrame, window_hours: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Whether each target has exactly one bar per hour over the last
    ``window_hours`` up to it: ``keys, ts, present_hours, continuous``.
    :func:`reached` tells which bars it needs.

    Time is cut into cells as long as the window, so that a window is the
    beginning of the target's cell and the end of the cell before. Good hours
    (one bar, on the hour) are counted once along each cell, which bars and
    targets reach in one shuffle; a target adds up its two parts in a second one.
    """
    keys = list(keys)
    hour, none = floor_hour("ts"), F.lit(0)
    step = max(1, window_hours) * 3600
    bar_rows = bars.select(*keys, hour.alias("ts"), F.lit(1).alias("_n"), (F.col("ts") == hour).cast("int").alias("_on"), none.alias("_end"),
                           none.alias("_start"))
    ends = targets.select(*keys, "ts", none.alias("_n"), none.alias("_on"), F.lit(1).alias("_end"), none.alias("_start"))
    starts = targets.select(*keys, (F.col("ts") - hours(window_hours)).alias("ts"), none.alias("_n"), none.alias("_on"), none.alias("_end"),
                            F.lit(1).alias("_start"))
    cell = F.floor(epoch_seconds("ts") / step).alias("_cell")
    dealt = stack(bar_rows, ends, starts).select("*", cell).repartition(*keys, "_cell")
    line = dealt.groupBy(*keys, "_cell", "ts").agg(
        ((F.sum("_n") == 1) & (F.sum("_on") == 1)).cast("long").alias("_good"), F.max("_end").alias("_end"), F.max("_start").alias("_start"))
    along = Window.partitionBy(*keys, "_cell").orderBy("ts")
    whole = F.sum("_good").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counted = line.select(*keys, "ts", "_end", "_start", F.sum("_good").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
                          whole.alias("_whole"))
    parts = F.array_compact(F.array(
        F.when(F.col("_end") == 1, F.struct("ts", F.col("_upto").alias("n"))),
        F.when(F.col("_start") == 1, F.struct((F.col("ts") + hours(window_hours)).alias("ts"), (F.col("_whole") - F.col("_upto")).alias("n")))))
    each = counted.select(*keys, F.explode(parts).alias("_p")).groupBy(*keys, F.col("_p.ts").alias("ts")).agg(F.sum("_p.n").alias("present_hours"))
    on_hour = F.col("ts") == floor_hour("ts")
    return each.withColumn("continuous", (F.col("present_hours") == window_hours) & on_hour)


class BrokenHistory(ValueError):
    """Bars are missing where a gapless or longer history is required."""


def require_continuity(bars: DataFrame, targets: DataFrame, window_hours: int, keys: Sequence[str] = ("series",)
                       ) -> DataFrame:
    """Raise when any target's window has a gap (an action), else return targets."""
    broken = continuity(bars, targets, window_hours, keys).where(~F.col("continuous"))
    first = broken.orderBy("ts", *keys).limit(10).collect()
    if first:
        raise BrokenHistory(f"no gapless {window_hours}h before {[tuple(r) for r in first]}")
    return targets


def missing_hours(bars: DataFrame, keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS
                  ) -> DataFrame:
    """Hours without a bar between a series' first and last bar."""
    keys = list(keys)
    present = bars.select(*keys, floor_hour("ts").alias("ts")).distinct()
    stepped = running(present, keys, ["ts"], lasts={"_prev": F.col("ts")}, include_current=False,
                      chunk_hours=chunk_hours)
    gaps = stepped.where(F.col("ts") > F.col("_prev") + hours(1))
    inside = F.sequence(F.col("_prev") + hours(1), F.col("ts") - hours(1), hours(1))
    return gaps.select(*keys, F.explode(inside).alias("ts"))


def latest_complete_hour(bars: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    return (bars.where(F.col("ts") == floor_hour("ts")).groupBy(*keys).agg(F.max("ts").alias("latest_hour")))


def trim_partial(bars: DataFrame, keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """Drop the rows after each series' last whole hour.

    The last hour is told to each time chunk of its series that has rows, so rows are
    joined by series and chunk: a series with a large share of them spreads.
    """
    keys = list(keys)
    placed = add_chunk(bars, "ts", chunk_hours)
    whole = F.max(F.when(F.col("ts") == floor_hour("ts"), F.col("ts")))
    chunks = placed.groupBy(*keys, CHUNK).agg(whole.alias("_whole"))  # one row per chunk from here on
    told = chunks.select(*keys, CHUNK, F.max("_whole").over(Window.partitionBy(*keys)).alias("_latest"))
    return placed.join(told, [*keys, CHUNK]).where(F.col("ts") <= F.col("_latest")).select(*[F.col(f"`{c}`") for c in bars.columns])


def history(bars: DataFrame, required_hours: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Per series: whole-hour rows up to the last whole hour, that hour, and
    whether there are at least ``required_hours`` rows."""
    trimmed = trim_partial(bars, keys)
    return trimmed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("latest_ts")).withColumn(
        "enough", F.col("n") >= required_hours)


def require_history(bars: DataFrame, required_hours: int, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Trimmed bars; raises when a series has fewer than ``required_hours`` rows."""
    short = history(bars, required_hours, keys).where(~F.col("enough")).limit(10).collect()
    if short:
        raise BrokenHistory(f"fewer than {required_hours} rows: {[tuple(r) for r in short]}")
    return trim_partial(bars, keys)


def lookback_at(store: DataFrame, wanted: DataFrame, keys: Sequence[str] = ("series", "timeframe", "ts_key")
                ) -> DataFrame:
    """Stored windows of the wanted keys."""
    return store.join(wanted.select(*keys).distinct(), list(keys), "left_semi")


def absent_lookbacks(store: DataFrame, wanted: DataFrame, keys: Sequence[str] = ("series", "timeframe", "ts_key")
                     ) -> DataFrame:
    """Wanted keys the store does not have."""
    return wanted.select(*keys).distinct().join(store.select(*keys), list(keys), "left_anti")


def marker_levels(outcomes: DataFrame) -> DataFrame:
    """Where a signal's marker goes: 0.2 % above the high for a win, 0.2 % below
    the low otherwise."""
    win = F.col("outcome_sign") > 0
    lose = F.col("outcome_sign") <= 0
    level = F.when(win, F.col("high") * 1.002).when(lose, F.col("low") * 0.998)
    return outcomes.withColumn("marker", level)
