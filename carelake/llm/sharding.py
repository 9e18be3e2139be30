"""Sharding by a Feistel permutation of global row numbers.

Rows get global numbers 0..N-1 in the order of all their columns. A Feistel
network permutes the numbers: it is a permutation of the next power of four, and
a number that lands at N or beyond is sent through again until it lands below
(cycle walking), which makes it a permutation of 0..N-1. The permuted place p
gives shard p mod shards and slot p div shards: shard sizes differ by one at
most, slots have no gaps, the order is a reproducible shuffle, and the place of
a row, or the row of a place (``row_at``), follows from the numbers alone.

Numbering: equal rows are counted before the shuffle, so many copies move as
one; rows are sorted by range over all columns and copy number and written with
their place in their partition; partition sizes (one row each) give the offsets.

Defined results: nulls sort first and are values like others; repeated rows get
numbers, places and slots of their own; an empty table gives an empty result;
columns named like an output are replaced by it. Columns must be orderable.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from carelake.llm.common import ROW, map_arrow, materialise, unpack

ROUNDS = 6
SEED = 42
COPIES_AT_ONCE = 10_000
# The Mersenne prime 2**31 - 1 and two Lehmer multipliers for it.
PRIME = 2147483647
MULTIPLIERS = (1583458089, 784588716)


def round_key(seed: int, k: int) -> int:
    return (seed * 1000003 + k * 7368787 + 12345) % PRIME


def half_bits(n: int) -> int:
    """Half the bits of the least power of four that holds 0..n-1."""
    return max(1, -(-max(0, n - 1).bit_length() // 2))


def _mixed(right: np.ndarray, key: int) -> np.ndarray:
    t = (right + key) % PRIME * MULTIPLIERS[0] % PRIME
    t = t ^ (t >> 15)
    t = t % PRIME * MULTIPLIERS[1] % PRIME
    return t ^ (t >> 13)


def _network(x: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask = (1 << half) - 1
    left, right = x >> half, x & mask
    for key in keys:
        left, right = right, left ^ (_mixed(right, key) & mask)
    return (left << half) | right


def _walk(x: np.ndarray, n: int, step) -> np.ndarray:
    x = step(np.asarray(x, dtype=np.int64))
    while (out := x >= n).any():
        x[out] = step(x[out])
    return x


def permute(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The places of row numbers below ``n`` (up to 2**62)."""
    keys = [round_key(seed, k) for k in range(ROUNDS)]
    return _walk(numbers, n, lambda x: _network(x, half_bits(n), keys))


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The global number of the row at a slot of a shard: the network backwards
    (the halves swapped, the keys in reverse)."""
    half, mask = half_bits(n), (1 << half_bits(n)) - 1
    keys = [round_key(seed, k) for k in reversed(range(ROUNDS))]
    swap = lambda x: ((x & mask) << half) | (x >> half)
    place = np.array([slot * shards + shard], dtype=np.int64)
    return int(_walk(place, n, lambda x: swap(_network(swap(x), half, keys)))[0])


def number_rows(df: DataFrame) -> DataFrame:
    """All rows with ``row_number`` (from 0, in the order of all columns)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    # Copies of a row: counted, then listed in two steps, so that no task lists very many.
    counted = df.select(F.struct(*cols).alias(ROW)).groupBy(ROW).agg(F.count("*").alias("copies"))
    blocks = counted.select(ROW, "copies", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(COPIES_AT_ONCE))).alias("from"))
    single = blocks.where("copies = 1").select(ROW, F.col("from").alias("copy"))
    several = blocks.where("copies > 1").repartition("from", ROW).select(
        ROW, F.explode(F.sequence(F.col("from"), F.least(F.col("copies"), F.col("from") + COPIES_AT_ONCE) - 1)).alias("copy"))
    ranged = single.union(several).repartitionByRange(ROW, "copy").sortWithinPartitions(ROW, "copy")
    written = materialise(ranged.select(ROW, F.monotonically_increasing_id().alias("key")), "shard-rows")
    part = F.shiftright("key", 33)
    sizes = written.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    offsets = sizes.select("part", (F.sum("size").over(W.orderBy("part")) - F.col("size")).alias("offset"))
    return written.withColumn("part", part).join(offsets, "part").withColumn(
        "row_number", F.col("offset") + F.col("key") - F.shiftleft("part", 33)).select(ROW, "row_number")


def assign_shards(df: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """All rows with ``row_number``, ``shard`` and ``slot``."""
    numbered = number_rows(df)
    n = numbered.agg(F.count("*")).first()[0]
    schema = T.StructType([*numbered.schema, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = permute(batch.column("row_number").to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((place % shards).astype(np.int32)), pa.array(place // shards)],
                                             names=schema.names)

    return unpack(map_arrow(numbered, run, schema), ["row_number", "shard", "slot"])


def write_shards(df: DataFrame, path: str, shards: int, seed: int = SEED) -> None:
    """Write the rows as one folder per shard, each in the order of its slots."""
    placed = assign_shards(df, shards, seed)
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
