"""Places of rows within groups of any size.

Rows are sorted by range over group, order and a spreading number, so a group
lies in as many partitions as its size needs and equal rows part, too. Every
partition counts along its own groups; a group that began in an earlier partition
is the first of those it goes on in, so one number for each partition (the rows
of its first group in those before) completes the places. That table has one row
for each partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from carelake.llm.common import map_arrow, materialise

PART, PLACE, OPENS, SPREAD = "_part", "_place", "_opens", "_spread"


def changes(column: pa.Array) -> np.ndarray:
    """For every value but the first whether it differs from the one before; nulls are equal."""
    if len(column) < 2:
        return np.zeros(0, dtype=bool)
    here, before = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.fill_null(pc.not_equal(here, before), False).to_numpy(zero_copy_only=False)
    return other | (here.is_null().to_numpy(zero_copy_only=False) != before.is_null().to_numpy(zero_copy_only=False))


def _count_along(group: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, size, opens = None, 0, True  # of the group at the end of the batch before
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(group)
            starts = np.concatenate(([0], np.flatnonzero(changes(column)) + 1))
            goes_on = last is not None and column[0].as_py() == last[0]
            began = np.zeros(batch.num_rows, dtype=np.int64)
            began[starts[1:]] = starts[1:]
            began = np.maximum.accumulate(began)
            place = np.arange(batch.num_rows) - began
            first = began == 0
            if goes_on:
                place[first] += size
            still = first & (last is None or (goes_on and opens))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place), pa.array(still)], names=names)
            last, size, opens = (column[-1].as_py(),), int(place[-1]) + 1, bool(still[-1])

    return run


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``at``, the place of a row (from 0) in its ``group`` (null is one)
    by ``order`` (nulls first; equal rows in any order), and (group, n). ``df`` should
    be read from a written table: it is read twice."""
    keys = [group, *order, SPREAD]
    ranged = df.withColumn(SPREAD, F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = ranged.drop(SPREAD).withColumn(PART, F.spark_partition_id())
    schema = T.StructType([*ranged.schema, T.StructField(PLACE, T.LongType()), T.StructField(OPENS, T.BooleanType())])
    written = materialise(map_arrow(ranged, _count_along(group, schema.names), schema), name)
    sizes = written.groupBy(group, PART).agg((F.max(PLACE) + 1).alias("n"))
    earlier = F.sum("n").over(W.partitionBy(group).orderBy(PART)) - F.col("n")
    before = sizes.select(PART, earlier.alias("_before")).where("_before > 0")  # a row for a partition at most
    rows = written.join(F.broadcast(before), PART, "left").withColumn(
        "at", F.col(PLACE) + F.when(F.col(OPENS), F.coalesce("_before", F.lit(0))).otherwise(0))
    return rows.drop(PART, PLACE, OPENS, "_before"), sizes.groupBy(group).agg(F.sum("n").alias("n"))
