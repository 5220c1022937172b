"""Places in a total order of all rows, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crestline.plans.scratch import Scratch


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Adds the place of every row, from 1: rows are range-sorted, counted per range, and ranked within their range.

    The order should tell all rows apart; rows that tie get places next to each other. An empty table gives no row.
    """
    cut = Scratch(df.sparkSession, "ranks")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the range of a row is written with it, so it is the same whenever it is read
    held = cut.cut(df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()))
    # one row per range
    counts = held.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select("__range", before.alias("__before")))
    within = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return held.withColumn("__within", within).join(offsets, "__range").withColumn(name, F.col("__before") + F.col("__within")).drop("__range", "__within", "__before")
