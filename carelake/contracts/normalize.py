"""Output normalisation shared by the Spark contract queries and the oracle.

Double sums depend on summation order, which differs between engines and
partitionings. Fixture money is exact to 4 decimals, so:

* sums are rounded to 4 decimals (the exact value; no tie is possible);
* a mean is re-derived from its exact sum: ``round(mean * n, 4) / n`` is
  the same correctly rounded double in every engine, where rounding the
  mean itself would hit half-way ties for small groups;
* standard deviations are rounded to 4 decimals.

The SQL twins of these helpers live in ``carelake.contracts.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def money(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in cols})


def mean(df: DataFrame, col: str, n: str) -> DataFrame:
    return df.withColumn(col, F.round(F.col(col) * F.col(n), 4) / F.nullif(F.col(n), F.lit(0)))
