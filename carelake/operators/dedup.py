"""Keep one row per key under a total order.

``row_number() = 1`` over a window is what Spark plans best here: Catalyst
turns the filter into a WindowGroupLimit that runs once *before* the
shuffle (keeping one row per key and map partition) and once after it. A
key that holds a third of all rows therefore sends at most one row per map
partition across the network instead of all of its rows to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.sources.claims_csv import INGEST_ORDER


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank_col: str = "row_num") -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order``.

    ``order`` should be total (end it with a unique column such as the file
    order key), otherwise the kept row among ties is arbitrary.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
              .where(F.col(rank_col) == 1)
              .drop(rank_col))


def latest_claim_order(df: DataFrame) -> list[Column]:
    """W1's order: latest from-date first, then the lowest line number (a
    NULL line sorts first), then file order to break remaining ties."""
    order = [F.col("claim_from_date").desc_nulls_last(), F.col("claim_line_num").asc_nulls_first()]
    if INGEST_ORDER in df.columns:
        order.append(F.col(INGEST_ORDER).asc_nulls_first())
    else:
        order += [F.col(c).asc_nulls_first() for c in
                  ("provider_id", "diagnosis_code", "total_charges", "claim_amount")]
    return order


def int_claims_deduplicated(stg: DataFrame) -> DataFrame:
    """One representative row per claim_id."""
    return keep_one(stg, ["claim_id"], latest_claim_order(stg))


def keep_first(df: DataFrame, keys: Sequence[str], seq: Sequence[str] = (INGEST_ORDER,)) -> DataFrame:
    """W2-W5: "drop duplicates, keep first" with first meaning file order."""
    return keep_one(df, keys, [F.col(c).asc_nulls_first() for c in seq])
