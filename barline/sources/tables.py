"""Readers and normalisers for bars, scores and feature files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barline.functions.columns import BAR_COLUMNS, coerce_numeric, number, parse_ts, require_columns, ts_lit
from barline.session import stack

# Accepted names of the time column and of the score column.
TIME_NAMES = ("timestamp", "time", "datetime", "date")
SCORE_NAMES = ("y_pred", "prediction", "pred", "y")

_CSV = {"header": "true"}
_PARQUET_SUFFIXES = (".parquet", ".pq")


def in_range(df: DataFrame, ts: str = "ts", start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with ``start <= ts <= end``; an absent bound is open.

    Bounds are literals, so the range reaches the parquet scan.
    """
    if start is not None:
        df = df.where(F.col(ts) >= ts_lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= ts_lit(end))
    return df


def read_bars(spark: SparkSession, table: str, start: str | None = None, end: str | None = None,
              columns: Sequence[str] = ("series", "ts", *BAR_COLUMNS)) -> DataFrame:
    """Bars of a catalog table or a parquet path, both ends inclusive.

    Sort the result (``orderBy('series', 'ts')``) only where the order is
    shown or written; a scan does not need it.
    """
    path_like = "/" in table or table.endswith(_PARQUET_SUFFIXES)
    df = spark.read.parquet(table) if path_like else spark.table(table)
    return in_range(df.select(*columns), "ts", start, end)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV or parquet by the file name's ending; anything else is read as CSV."""
    if path.lower().rstrip("/").endswith(_PARQUET_SUFFIXES):
        return spark.read.parquet(path)
    return spark.read.options(**_CSV).csv(path)


def time_column(df: DataFrame, candidates: Sequence[str] = TIME_NAMES) -> str:
    """The first candidate the frame has, else its first column."""
    return next((c for c in candidates if c in df.columns), df.columns[0])


def resolve_time(df: DataFrame, candidates: Sequence[str] = TIME_NAMES, out: str = "timestamp") -> DataFrame:
    """Parse the time column and put it first under the name ``out``."""
    source = time_column(df, candidates)
    rest = [c for c in df.columns if c != source and c != out]
    return df.select(parse_ts(F.col(f"`{source}`")).alias(out), *[F.col(f"`{c}`") for c in rest])


def bar_time(df: DataFrame) -> Column:
    """Bar time from ``timestamp``, else ``time``, else ``open_time`` in epoch ms."""
    for name in ("timestamp", "time"):
        if name in df.columns:
            return parse_ts(name)
    if "open_time" in df.columns:
        return F.timestamp_millis(F.col("open_time").try_cast("bigint")).cast("timestamp_ntz")
    raise ValueError(f"no time column among {df.columns}")


def file_order() -> list[Column]:
    """Source position of file rows, as ``_path, _start, _row``: the file, the
    block the row came from, and its running number inside the task."""
    return [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row")]


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; rows without a key are dropped.

    Each map task already drops all but its best row per key, so a key with
    very many copies costs no more than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.dropna(subset=list(keys)).withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def read_csv_bars(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Bars from CSV: headers cleaned, time parsed, first row per time kept,
    numbers coerced. ``keys`` are further key columns to carry."""
    raw = spark.read.options(**_CSV).csv(path)
    names = [str(c).strip().lower() for c in raw.columns]
    placed = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(raw.columns, names)], *file_order())
    placed = placed.withColumn("timestamp", bar_time(placed))
    placed = require_columns(placed, [*keys, *BAR_COLUMNS])
    first = dedup(placed, [*keys, "timestamp"], [F.col("_path"), F.col("_start"), F.col("_row")])
    return coerce_numeric(first, BAR_COLUMNS).select(*keys, "timestamp", *BAR_COLUMNS)


def pick_score(df: DataFrame, names: Sequence[str] = SCORE_NAMES, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, timestamp, y_pred)`` from whichever score column is there."""
    require_columns(df, ["timestamp", *keys])
    source = next((c for c in names if c in df.columns), None)
    if source is None:
        raise ValueError(f"no score column; looked for {list(names)}")
    picked = df.select(*keys, parse_ts("timestamp").alias("timestamp"), number(source).alias("y_pred"))
    return picked.dropna(subset=["timestamp", "y_pred"])


def read_scores(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    return pick_score(read_any(spark, path), keys=keys)


def _list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths directly in ``folder`` matching ``pattern``, on any file system."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(base, pattern))
    return sorted(status.getPath().toString() for status in (found or []))


def union_splits(spark: SparkSession, folder: str, pattern: str = "pred_*.csv", fallback: str = "*.csv",
                 keys: Sequence[str] = ()) -> DataFrame:
    """All score files of a folder as one; per time the last occurrence wins,
    files in name order. Files without a time and score column are skipped."""
    paths = _list_files(spark, folder, pattern) or _list_files(spark, folder, fallback)
    frames = []
    for number_in_order, path in enumerate(paths):
        raw = spark.read.options(**_CSV).csv(path)
        if "y_pred" not in raw.columns:
            continue
        stamp = "timestamp" if "timestamp" in raw.columns else raw.columns[0]
        frames.append(raw.select(
            *keys, parse_ts(F.col(f"`{stamp}`")).alias("timestamp"), number("y_pred").alias("y_pred"),
            F.lit(number_in_order).alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_row")))
    if not frames:
        raise FileNotFoundError(f"no usable score files in {folder}")
    rows = stack(*frames).dropna(subset=["y_pred"])
    return dedup(rows, [*keys, "timestamp"], [F.desc("_file"), F.desc("_start"), F.desc("_row")]).select(
        *keys, "timestamp", "y_pred")


def read_split_rows(splits: DataFrame, rows: DataFrame) -> DataFrame:
    """Match split time stamps with feature rows by position.

    ``splits`` has one column ``split_timestamps: map<string, array<string>>``;
    ``rows`` has ``split, row_idx`` and the features. Files carry no row order
    in Spark, so ``row_idx`` must be in the data.
    """
    lists = splits.select(F.explode("split_timestamps").alias("split", "stamps"))
    stamps = lists.select("split", F.posexplode("stamps").alias("row_idx", "stamp"))
    stamps = stamps.select("split", "row_idx", parse_ts("stamp").alias("timestamp"))
    return stamps.join(rows, ["split", "row_idx"])
