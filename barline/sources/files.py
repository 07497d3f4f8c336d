"""Small side files: time lists, feature lists, run metadata, newest files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.functions.columns import parse_ts

# The metadata files of a training run.
RUN_FILES = ("run_metadata.json", "pipeline_config.json", "metrics.json")


def distinct_times(df: DataFrame, column: str, out: str = "ts") -> DataFrame:
    """Parsed, distinct time stamps of a text column; unparsable ones dropped."""
    return df.select(parse_ts(column).alias(out)).where(F.col(out).isNotNull()).distinct()


def parse_ts_list(spark: SparkSession, stamps: Iterable[str], out: str = "ts") -> DataFrame:
    """Time stamps given as strings, for lists a caller passes in."""
    listed = spark.createDataFrame([(s,) for s in stamps], "stamp string")
    return distinct_times(listed, "stamp", out)


def read_ts_file(spark: SparkSession, path: str, out: str = "ts") -> DataFrame:
    """One time stamp per line; blank lines and a missing file give no rows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return spark.createDataFrame([], f"{out} timestamp_ntz")
    return distinct_times(spark.read.text(path), "value", out)


def feature_list(text: Column, strict: bool = False) -> Column:
    """``array<string>`` from a JSON list or an object with key ``features``.

    What is neither gives an empty list, or an error when ``strict``.
    """
    body = F.trim(text)
    inner = F.when(body.startswith("{"), F.get_json_object(body, "$.features")).otherwise(body)
    names = F.when(F.trim(inner).startswith("["), F.from_json(inner, "array<string>"))
    failed = F.raise_error(F.lit("expected a JSON list of names or an object with key 'features'"))
    return F.coalesce(names, failed.cast("array<string>") if strict else F.array().cast("array<string>"))


def read_feature_list(spark: SparkSession, path: str, strict: bool = False, recursive: bool = False) -> DataFrame:
    """One row per file: ``path, features``; ``recursive`` takes the files of all folders below."""
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    raw = reader.text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_path").alias("path"),
                      feature_list(F.col("value"), strict).alias("features"))


def read_run_metadata(spark: SparkSession, root: str) -> DataFrame:
    """One row per run folder and readable metadata file: ``run, file, content``.

    Files that are missing or hold no JSON object are left out.
    """
    pattern = "{" + ",".join(RUN_FILES) + "}"
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
           .text(root, wholetext=True))
    path = F.col("_metadata.file_path")
    run = F.regexp_replace(path, "/[^/]+$", "")
    good = F.try_parse_json(F.col("value")).isNotNull()
    return raw.where(good).select(run.alias("run"), F.col("_metadata.file_name").alias("file"),
                                  F.col("value").alias("content"))


def file_times(spark: SparkSession, root: str, pattern: str, recursive: bool = False) -> DataFrame:
    """``path, modified`` of the matching files; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(root).select("path", F.col("modificationTime").alias("modified"))


def latest_file(spark: SparkSession, root: str, pattern: str, recursive: bool = False) -> str:
    """Path of the newest match; equal times go to the greater path."""
    row = (file_times(spark, root, pattern, recursive)
           .agg(F.max_by("path", F.struct("modified", "path")).alias("path")).first())
    if row is None or row.path is None:
        raise FileNotFoundError(f"no file matching {pattern} under {root}")
    return row.path
