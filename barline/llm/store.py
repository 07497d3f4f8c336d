"""Tables written once to the shared folder, and files that tasks write there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.session import open_fs, scratch_path  # noqa: F401


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to a new place in the shared folder and read
    back: later passes read the table, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Send texts to Python in batches that stay small when texts are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)
    return spark


class Carried:
    """Columns that go through pandas unchanged, under the names ``c0``, ``c1``
    and so on. Whole numbers go as text: pandas would turn a batch with a NULL
    into doubles, which do not hold large ids."""

    def __init__(self, df: DataFrame, names: Sequence[str]):
        self.names, self.held = list(names), [f"c{i}" for i in range(len(names))]
        self.types = [df.schema[n].dataType.simpleString() for n in names]
        self.sent = ["string" if t in ("tinyint", "smallint", "int", "bigint") else t for t in self.types]
        self.columns = [df[n].cast(s).alias(h) if s != t else df[n].alias(h)
                        for n, h, s, t in zip(self.names, self.held, self.sent, self.types)]
        self.ddl = ", ".join(f"{h} {s}" for h, s in zip(self.held, self.sent))

    def back(self, made: DataFrame) -> DataFrame:
        """The columns with their names and types, then the others."""
        mine = [F.col(h).cast(t).alias(n) for h, t, n in zip(self.held, self.types, self.names)]
        return made.select(*mine, *[c for c in made.columns if c not in self.held])


@contextmanager
def runtime_filters(spark: SparkSession) -> Iterator[None]:
    """Let Spark filter the large side of a join by a Bloom filter of the other
    side, whatever their sizes, for what is written inside. The filter's size is
    bounded by Spark's settings; a full one only filters less."""
    base = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = {base + "applicationSideScanSizeThreshold": "1b", base + "creationSideThreshold": "1t"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fresh_name(suffix: str) -> str:
    """A name no other task or attempt uses. Only names that the committed
    manifest lists count, so files of lost attempts are never read."""
    return uuid.uuid4().hex + suffix
