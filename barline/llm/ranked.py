"""Positions of rows in the order of their group, without a task per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.store import staged


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 on within ``group`` (NULL is a
    group) by ``order``, NULL first; and ``group_rows``. Rows equal in all of
    ``order`` get places of their own.

    The rows are stored with a tie number, dealt out by range and stored again,
    so that every later pass sees the same parts. A part is numbered by itself
    and moved by the counts of the parts before it; a group of any size spreads
    over as many parts as it fills.
    """
    spark = rows.sparkSession
    keys = [group, *order, "_tie"]
    fixed = staged(rows.withColumn("_tie", F.monotonically_increasing_id()), "unranked")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(fixed.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "parts")
    runs = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    of_group = Window.partitionBy(group)
    before = F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"),
                       F.sum("_n").over(of_group).alias("group_rows"))
    inside = Window.partitionBy("_part", group).orderBy(*order, "_tie")
    placed = dealt.withColumn("_at", F.row_number().over(inside) - 1)
    joined = placed.join(runs, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn("pos", F.col("_at") + F.col("_before")).drop("_tie", "_part", "_g", "_p", "_at", "_before")
