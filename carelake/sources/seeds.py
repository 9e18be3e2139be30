"""The state-code seed table (fixed, 53 rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Numeric provider state code and state name, as seeded.
STATE_CODES = [
    (1, "Alabama"), (2, "Alaska"), (3, "Arizona"), (4, "Arkansas"), (5, "California"),
    (6, "Colorado"), (7, "Connecticut"), (8, "Delaware"), (9, "District of Columbia"),
    (10, "Florida"), (11, "Georgia"), (12, "Hawaii"), (13, "Idaho"), (14, "Illinois"),
    (15, "Indiana"), (16, "Iowa"), (17, "Kansas"), (18, "Kentucky"), (19, "Louisiana"),
    (20, "Maine"), (21, "Maryland"), (22, "Massachusetts"), (23, "Michigan"), (24, "Minnesota"),
    (25, "Mississippi"), (26, "Missouri"), (27, "Montana"), (28, "Nebraska"), (29, "Nevada"),
    (30, "New Hampshire"), (31, "New Jersey"), (32, "New Mexico"), (33, "New York"),
    (34, "North Carolina"), (35, "North Dakota"), (36, "Ohio"), (37, "Oklahoma"), (38, "Oregon"),
    (39, "Pennsylvania"), (40, "Puerto Rico"), (41, "Rhode Island"), (42, "South Carolina"),
    (43, "South Dakota"), (44, "Tennessee"), (45, "Texas"), (46, "Utah"), (47, "Vermont"),
    (48, "Virginia"), (49, "Washington"), (50, "West Virginia"), (51, "Wisconsin"), (52, "Wyoming"),
    (53, "Virgin Islands"),
]


def state_codes(spark: SparkSession) -> DataFrame:
    """The seed as a DataFrame(state_code bigint, state_name string).

    53 rows by definition.
    """
    values = ", ".join(f"({code}L, '{name}')" for code, name in STATE_CODES)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(state_code, state_name)")


def read_state_codes_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load the seed from its headered CSV file (state_code,state_name)."""
    raw = spark.read.option("header", True).schema("state_code string, state_name string").csv(path)
    return raw.select(F.col("state_code").cast("bigint").alias("state_code"), "state_name")


def with_state_name(df: DataFrame, key, states: DataFrame, out: str, default: str = "Unknown") -> DataFrame:
    """LEFT join ``df`` to the seed on a numeric key expression and add
    ``out`` = state name, or ``default`` when the key does not map.

    The planner sees the seed's size (53 built-in rows, or the size of a seed
    file) and broadcasts it, so ``df`` is not shuffled; a file of any size works.
    """
    seed = states.select(F.col("state_code").alias("__state_code"),
                         F.col("state_name").alias("__state_name"))
    joined = df.withColumn("__state_key", key).join(
        seed, F.col("__state_key") == F.col("__state_code"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__state_name"), F.lit(default)))
                  .drop("__state_key", "__state_code", "__state_name"))
