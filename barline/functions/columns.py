"""Scalar column helpers shared by all operators.

Timestamps are naive UTC (``timestamp_ntz``) everywhere. Missing numbers are
NULL: NaN is turned into NULL on entry, because Spark treats NaN as a value
that equals itself and sorts above everything.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bar columns in their order, and hours per timeframe label.
BAR_COLUMNS = ("open", "high", "low", "close", "volume")
TIMEFRAME_HOURS = {"1H": 1, "4H": 4, "12H": 12, "1D": 24}
TS_KEY_FORMAT = "yyyyMMdd_HHmmss"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours(n: int) -> Column:
    """An interval of ``n`` hours, for adding to timestamps."""
    return F.expr(f"make_dt_interval(0, {int(n)}, 0, 0)")


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(col(c).cast("timestamp"))


def epoch_micros(c: Column | str) -> Column:
    return F.unix_micros(col(c).cast("timestamp"))


def floor_hour(c: Column | str) -> Column:
    return F.date_trunc("hour", col(c)).cast("timestamp_ntz")


def floor_timeframe(c: Column | str, timeframe_hours: int) -> Column:
    """Start of the epoch-aligned bar of ``timeframe_hours`` that holds ``c``."""
    if timeframe_hours == 1:
        return floor_hour(c)
    step = int(timeframe_hours) * 3600
    return F.timestamp_seconds(F.floor(epoch_seconds(c) / step) * step).cast("timestamp_ntz")


def parse_ts(c: Column | str) -> Column:
    """Text (or a timestamp) to naive UTC; what cannot be parsed becomes NULL.

    Text with an offset is converted to UTC; text without one is UTC already.
    """
    return F.try_to_timestamp(F.trim(col(c).cast("string"))).cast("timestamp_ntz")


def naive_utc(value: str | datetime) -> pd.Timestamp:
    """A bound given by the caller as naive UTC; offsets are converted."""
    stamp = pd.Timestamp(value)
    return stamp.tz_convert("UTC").tz_localize(None) if stamp.tzinfo else stamp


def ts_lit(value: str | datetime) -> Column:
    """A time literal, folded to a constant so that it reaches the scan."""
    return F.lit(naive_utc(value).isoformat(sep=" ")).cast("timestamp_ntz")


def ts_key(c: Column | str) -> Column:
    return F.date_format(col(c), TS_KEY_FORMAT)


def parse_ts_key(c: Column | str) -> Column:
    return F.try_to_timestamp(col(c), F.lit(TS_KEY_FORMAT)).cast("timestamp_ntz")


def number(c: Column | str) -> Column:
    """Coerce to double: text that is no number and NaN become NULL."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(f"`{c}`")) for c in columns})


def finite(c: Column | str) -> Column:
    """The value when it is a finite number, else NULL."""
    value = col(c)
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def all_close(a: Column | str, b: Column | str, rtol: float, atol: float,
              nan_equal: bool = False) -> Column:
    """``|a-b| <= atol + rtol*|b|``; a missing side is unequal unless both are
    missing and ``nan_equal`` is set."""
    a, b = col(a), col(b)
    same = F.coalesce(a == b, F.lit(False))
    near = F.coalesce(F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b), F.lit(False))
    both_missing = a.isNull() & b.isNull()
    return same | near | both_missing if nan_equal else same | near


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming the columns ``df`` lacks, else return it."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
