"""Global row numbers under a total order, without one task for all rows.

Rows are dealt out and sorted by range and written with their place in their
range; a range's offset is the size of those before it (one row for each range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import scratch_path

_LOCAL = (1 << 33) - 1  # the place in the partition, in Spark's increasing id


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``df`` with its row number (from 1) under ``order``, which should be total.

    The sorted rows are written once below the shared scratch folder: range borders
    come from a sample, so a second run of the sort could draw others."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranked")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__id", 33))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    ranked = rows.join(F.broadcast(before), "__part")
    return ranked.withColumn(name, F.col("__before") + F.col("__id").bitwiseAND(F.lit(_LOCAL)) + 1).drop("__part", "__id", "__before")
