"""Moving averages, relative strength, MACD and lags over bars.

Definitions are the published textbook ones. Names carry the timeframe as a
suffix, for example ``close_sma_20_4H``.

``indicators`` works on the bars of one timeframe as they are. ``recompute``
gives, for every bar time, the values a trader would have seen at that time:
the timeframe's newest bar is then only as far as the time itself. Nothing is
copied per target; both are window computations over the bars.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barline.functions.columns import TIMEFRAME_HOURS, number
from barline.functions.scans import DEFAULT_BLOCK_ROWS, DEFAULT_CHUNK_HOURS, POSITION, over_rows, positions
from barline.operators.series import bars_so_far, by_timeframe, continuity, longer_bars, reached
from barline.session import cut

# Rows after which an exponential average has forgotten its start to double
# precision: (1 - alpha)^n below this.
FORGOTTEN = 1e-18
# Largest power of ten the rescaled sums may reach inside a block.
MAX_EXPONENT = 280


@dataclass(frozen=True)
class IndicatorSpec:
    sma: tuple[int, ...] = (20,)
    rsi: int = 14
    macd: tuple[int, int] = (12, 26)
    volume_ma: int = 20

    @property
    def reach(self) -> int:
        return max([*self.sma, self.rsi, self.volume_ma]) + 1


def _alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def _forget_rows(span: int) -> int:
    return math.ceil(math.log(FORGOTTEN) / math.log(1.0 - _alpha(span)))


def _largest_block(span: int) -> int:
    """Rows over which the powers of ``1-alpha`` stay in range."""
    return int(MAX_EXPONENT / -math.log10(1.0 - _alpha(span)))


def _ema(x: Column, span: int, w: WindowSpec) -> Column:
    """Exponential average from a running sum: the recursion
    ``y = (1-a)*y + a*x`` unrolled and rescaled by ``(1-a)^offset``, where the
    offset restarts in each block and so keeps the powers small."""
    a = _alpha(span)
    scale = F.pow(F.lit(1.0 - a), F.col("_offset").cast("double"))
    weight = F.when(F.col(POSITION) == 0, 1.0).otherwise(a)
    return F.sum(weight * x / scale).over(w.rowsBetween(Window.unboundedPreceding, 0)) * scale


def ema_columns(df: DataFrame, value: str, spans: Sequence[int], keys: Sequence[str], order: Sequence[str],
                chunk_hours: int = DEFAULT_CHUNK_HOURS, *,
                also: Callable[[WindowSpec], Mapping[str, Column]] | None = None) -> DataFrame:
    """Add ``_ema_<span>`` of ``value`` for each span, from each key's first row,
    and the columns of ``also`` in the same pass.

    Blocks of rows overlap by as many rows as an average remembers. Spans too
    different to share one block size are computed one after the other.
    """
    context = max(_forget_rows(s) for s in spans)
    block = min(min(_largest_block(s) for s in spans) - context, DEFAULT_BLOCK_ROWS)
    if len(spans) > 1 and block < 4 * context:
        for i, s in enumerate(spans):
            df = ema_columns(df, value, [s], keys, order, chunk_hours, also=None if i else also)
        return df

    def columns(w: WindowSpec) -> dict[str, Column]:
        return {**{f"_ema_{s}": _ema(F.col(value), s, w) for s in spans}, **(also(w) if also else {})}

    return over_rows(df, keys, order, columns, before=context, block_rows=block, chunk_hours=chunk_hours)


def _step(w: WindowSpec) -> dict[str, Column]:
    """The close before and the move from it."""
    prev = F.lag("close").over(w)
    return {"_prev_close": prev, "_step": F.col("close") - prev}


def _mean_of_last(total: Column, count: Column, n: int) -> Column:
    return F.when(count == n, total / n)


def rsi_value(gain: Column, loss: Column) -> Column:
    """Relative strength from average gain and loss; 100 without losses, NULL
    without any movement."""
    return F.when((gain == 0) & (loss == 0), F.lit(None).cast("double")).otherwise(100.0 * gain / (gain + loss))


def indicators(bars: DataFrame, timeframe: str = "1H", spec: IndicatorSpec = IndicatorSpec(),
               keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """``keys, ts`` and the indicators of each bar. Averages over ``n`` bars
    are NULL until there are ``n``. Bars without a close are left out."""
    keys = list(keys)
    slim = bars.select(*keys, "ts", number("close").alias("close"), number("volume").alias("volume")
                       ).where("close is not null")
    fast, slow = spec.macd

    def averages(w: WindowSpec) -> dict[str, Column]:
        made = {}
        for n in spec.sma:
            f = w.rowsBetween(1 - n, 0)
            made[f"close_sma_{n}_{timeframe}"] = _mean_of_last(F.sum("close").over(f), F.count("close").over(f), n)
        f = w.rowsBetween(1 - spec.volume_ma, 0)
        made[f"volume_ma_{spec.volume_ma}_{timeframe}"] = _mean_of_last(
            F.sum("volume").over(f), F.count("volume").over(f), spec.volume_ma)
        f = w.rowsBetween(1 - spec.rsi, 0)
        gain = F.sum(F.greatest(F.col("_step"), F.lit(0.0))).over(f)
        loss = F.sum(F.greatest(-F.col("_step"), F.lit(0.0))).over(f)
        full = F.count("_step").over(f) == spec.rsi
        made[f"close_rsi_{spec.rsi}_{timeframe}"] = F.when(full, rsi_value(gain, loss))
        return made

    placed = positions(slim, keys, ["ts"], chunk_hours=chunk_hours)
    smoothed = ema_columns(placed, "close", spec.macd, keys, ["ts"], also=_step)
    made = over_rows(smoothed, keys, ["ts"], averages, before=spec.reach)
    macd = (F.col(f"_ema_{fast}") - F.col(f"_ema_{slow}")).alias(f"close_macd_{timeframe}")
    drop = {"_step", "_prev_close", f"_ema_{fast}", f"_ema_{slow}", "close", "volume", POSITION}
    return made.select(*[F.col(c) for c in made.columns if c not in drop], macd)


def lag_features(bars: DataFrame, columns: Sequence[str] = ("close",), lags: int = 14, timeframe: str = "1H",
                 keys: Sequence[str] = ("series",), chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """The current bar's columns and their values 1..``lags`` bars earlier:
    ``<column>_<TF>`` and ``<column>_lag_<k>_<TF>``."""
    slim = bars.select(*keys, "ts", *[F.col(c).alias(f"{c}_{timeframe}") for c in columns])

    def shifted(w: WindowSpec) -> dict[str, Column]:
        return {f"{c}_lag_{k}_{timeframe}": F.lag(f"{c}_{timeframe}", k).over(w)
                for c in columns for k in range(1, lags + 1)}

    return over_rows(slim, keys, ["ts"], shifted, before=lags, chunk_hours=chunk_hours)


def _per_timeframe(made: Mapping[str, Column], otherwise: Column | None = None) -> Column:
    """The column of a row's timeframe."""
    out = otherwise
    for timeframe, column in made.items():
        here = F.col("timeframe") == timeframe
        out = F.when(here, column) if out is None else F.when(here, column).otherwise(out)
    return out


def _history(full: DataFrame, spec: IndicatorSpec, keys: Sequence[str], rows: Mapping[str, int], chunk_hours: int) -> DataFrame:
    """What the indicators of a timeframe's newest bar need from the bars
    before it: sums over them and averages as of the bar before. Averages see
    the newest ``rows`` bars of the timeframe only, the newest one included. All timeframes go through one pass."""
    placed = positions(full, keys, ["bar_ts"], chunk_hours=chunk_hours)
    smoothed = ema_columns(placed, "close", spec.macd, keys, ["bar_ts"], also=_step)

    def sums(w: WindowSpec) -> dict[str, Column]:
        def framed(first: Callable[[int], int], value: Callable[[WindowSpec], Column]) -> Column:
            by_first: dict[int, list[str]] = {}
            for timeframe, n in rows.items():
                by_first.setdefault(first(n), []).append(timeframe)
            return _per_timeframe({tf: value(w.rowsBetween(k, -1)) for k, tfs in by_first.items() for tf in tfs})

        made = {}
        for n in spec.sma:
            made[f"_sum_{n}"] = framed(lambda r, n=n: max(1 - n, 1 - r), lambda f: F.sum("close").over(f))
            made[f"_cnt_{n}"] = framed(lambda r, n=n: max(1 - n, 1 - r), lambda f: F.count("close").over(f))
        made["_vsum"] = framed(lambda r: max(1 - spec.volume_ma, 1 - r), lambda f: F.sum("volume").over(f))
        made["_vcnt"] = framed(lambda r: max(1 - spec.volume_ma, 1 - r), lambda f: F.count("volume").over(f))
        # The average over the last rows-1 bars, started at the first of them:
        # the full average minus what the bars before that one contribute.
        for s in spec.macd:
            def past(r: int, s: int = s) -> Column:
                keep = (1.0 - _alpha(s)) ** max(r - 2, 0)
                start = F.lag(f"_ema_{s}", r - 1).over(w) - F.lag("close", r - 1).over(w)
                return F.lag(f"_ema_{s}").over(w) - F.coalesce(start * keep, F.lit(0.0))

            made[f"_past_{s}"] = _per_timeframe({tf: past(r) for tf, r in rows.items()})
        # The first bar in view has no bar to move from.
        moved = lambda r: max(1 - spec.rsi, min(2 - r, -1))
        made["_gain"] = framed(moved, lambda f: F.sum(F.greatest(F.col("_step"), F.lit(0.0))).over(f))
        made["_loss"] = framed(moved, lambda f: F.sum(F.greatest(-F.col("_step"), F.lit(0.0))).over(f))
        made["_moves"] = framed(moved, lambda f: F.count("_step").over(f))
        return made

    reach = max(spec.reach, *rows.values())
    made = over_rows(smoothed, keys, ["bar_ts"], sums, before=reach)
    return made.drop("open", "high", "low", "close", "volume", "_step", POSITION, *[f"_ema_{s}" for s in spec.macd])


def recompute_features(bars: DataFrame, targets: DataFrame, base_hours: int = 720, buffer_hours: int = 6,
                       timeframes: Sequence[str] = tuple(TIMEFRAME_HOURS), spec: IndicatorSpec = IndicatorSpec(),
                       keys: Sequence[str] = ("series",), require_gapless: bool = True,
                       chunk_hours: int = DEFAULT_CHUNK_HOURS) -> DataFrame:
    """One wide row of indicators per target, as seen at the target's time.

    Targets need a gapless history of ``base_hours + buffer_hours`` (the rest
    are left out); the indicators see ``base_hours`` of it, so no other bars are
    read. Without ``require_gapless`` gaps are made up for from further back, which reads whole series.
    """
    keys = list(keys)
    on, frame_keys = [*keys, "ts"], [*keys, "timeframe"]
    clean = bars.where(number("close").isNotNull())
    wanted = targets.select(*on).distinct()
    if require_gapless:
        history = base_hours + max(0, buffer_hours)
        wanted = continuity(reached(bars, wanted, history, keys), wanted, history, keys).where("continuous").select(*on)
        wanted = cut(wanted)  # the targets that count; all that follows is bounded by them
        clean = reached(clean, wanted, history + max(TIMEFRAME_HOURS[tf] for tf in timeframes), keys)
    fast, slow = spec.macd
    rows = {tf: max(2, base_hours // TIMEFRAME_HOURS[tf]) for tf in timeframes}
    placed = by_timeframe(clean, timeframes, keys)
    past = _history(longer_bars(placed, frame_keys), spec, frame_keys, rows, chunk_hours)
    now = bars_so_far(placed, frame_keys, wanted)
    seen = now.join(past, [*frame_keys, "bar_ts"])
    close, volume = F.col("close"), F.col("volume")
    step = close - F.col("_prev_close")
    made = {}
    for n in spec.sma:
        made[f"close_sma_{n}"] = F.when(F.col(f"_cnt_{n}") == n - 1, (F.coalesce(F.col(f"_sum_{n}"), F.lit(0.0)) + close) / n)
    made[f"volume_ma_{spec.volume_ma}"] = F.when(
        F.col("_vcnt") == spec.volume_ma - 1, (F.coalesce("_vsum", F.lit(0.0)) + volume) / spec.volume_ma)
    gain = F.coalesce("_gain", F.lit(0.0)) + F.greatest(step, F.lit(0.0))
    loss = F.coalesce("_loss", F.lit(0.0)) + F.greatest(-step, F.lit(0.0))
    made[f"close_rsi_{spec.rsi}"] = F.when(F.col("_moves") == spec.rsi - 1, rsi_value(gain, loss))
    ends = [F.coalesce((1.0 - _alpha(s)) * F.col(f"_past_{s}") + _alpha(s) * close, close) for s in (fast, slow)]
    made["close_macd"] = ends[0] - ends[1]
    # one row per target: at most one row per timeframe meets in a group
    wide = [F.max(F.when(F.col("timeframe") == tf, c)).alias(f"{n}_{tf}") for tf in timeframes for n, c in made.items()]
    there = F.count_if(F.col("timeframe").isin(list(timeframes)))
    return seen.groupBy(*on).agg(*wide, there.alias("_there")).where(F.col("_there") == len(timeframes)).drop("_there")
