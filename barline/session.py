"""Session settings the operators rely on, and shared scratch folders."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

UNION_PARTITIONING = "spark.sql.unionOutputPartitioning"


def build_session(app_name: str = "barline", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: both come
    from the submit configuration.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(UNION_PARTITIONING, "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # tables of cut() go with their frames
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators need in a session made elsewhere.

    Naive timestamps mean UTC, so casts between zoned and naive must use UTC.
    For the union setting see :func:`stack`.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    _plain_unions(spark)
    _ship(spark)
    return spark


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, wherever the
    session was started from."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="barline-")) / "barline.zip"  # Spark sends it on from the driver
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def _plain_unions(spark: SparkSession) -> None:
    if spark.conf.get(UNION_PARTITIONING, "false") != "false":
        spark.conf.set(UNION_PARTITIONING, "false")


def stack(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    """The rows of all frames, columns matched by name.

    Spark 4.1 can plan a union of equally partitioned inputs as if it kept
    their partitioning, and then not keep it where an exchange is reused: rows
    of one key end up apart. The setting is switched off for the session.
    """
    _plain_unions(frames[0].sparkSession)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` where the
    cluster names one, else (local runs and tests) a new temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="barline-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def open_fs(path: str):
    """The file system of a shared path, and the path on it, for reads and writes inside tasks."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def cut(df: DataFrame) -> DataFrame:
    """Store ``df`` once in the shared folder and go on from there, so that
    several passes over an expensive plan compute it a single time and a lost
    executor costs no recomputation of it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def once(df: DataFrame) -> DataFrame:
    """``df`` for several passes: stored first (see :func:`cut`) if computing it
    takes a shuffle, else as it is. Passes then see the same rows, and sums of
    doubles, which depend on the order of addition, can't differ between them."""
    return cut(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df
