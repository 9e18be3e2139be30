"""The file order of rows as one dense 64-bit number.

A reader marks every row with (path, split start, position); that struct sorts in
file order, but it carries a path through every shuffle. Once the rows are in a
table, ``dense_order`` measures them by split (three narrow columns), adds up the
splits in file order, and turns the struct into the row's number: its position
plus what lies before its split. Numbers of a whole file run from 0 without gaps; where
rows have been dropped before, they have gaps and still tell the file order.

The counts are one row for each split and are written, so the planner knows their
size when it decides how to join them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MARK = ["file", "offset", "row"]


def file_mark() -> Column:
    """(path, split start, position) of a row of a file read now."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("offset"),
                    F.monotonically_increasing_id().alias("row"))


def is_marked(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType if column in df.columns else None
    return kind is not None and kind.typeName() == "struct" and kind.names == MARK


def split_starts(df: DataFrame, column: str) -> DataFrame:
    """(file, offset, shift): what added to ``row`` gives the number. Positions of a
    split's rows follow each other, so its least and its greatest one are enough."""
    per_split = df.groupBy(F.col(f"{column}.file").alias("file"), F.col(f"{column}.offset").alias("offset")).agg(
        F.min(f"{column}.row").alias("first"), (F.max(f"{column}.row") - F.min(f"{column}.row") + 1).alias("n"))
    in_order = Window.orderBy("file", "offset")  # one row for each split of the files
    return per_split.select("file", "offset", (F.sum("n").over(in_order) - F.col("n") - F.col("first")).alias("shift"))


def dense_order(df: DataFrame, column: str, splits: DataFrame) -> DataFrame:
    """``df`` with ``column`` as its number, by the written ``splits`` of the same table."""
    known = splits.select(F.col("file").alias("__file"), F.col("offset").alias("__offset"), "shift")
    mark = F.col(column)
    joined = df.join(known, (mark["file"] == F.col("__file")) & (mark["offset"] == F.col("__offset")))
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return joined.select(*others, (mark["row"] + F.col("shift")).alias(column))
