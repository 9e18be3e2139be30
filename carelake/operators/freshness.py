"""Source freshness -- how old is the newest row of a source?

``now`` is a parameter (not the wall clock) so a run is reproducible. The
loaded-at column is text in any of the date forms of the raw files
(``functions.date_forms``, the reader that staging uses) or a date-time text. One
aggregation finds the newest value of each form and counts the values that are
no date in any; only then the forms are compared. The status is 'warn' past
``warn_after_hours``, 'error' past ``error_after_hours`` when given and when no
value can be read, else 'pass'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import date_forms

_DATE_TIME = r"{c} RLIKE r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?\z'"


def newest_by_form(df: DataFrame, column: str) -> DataFrame:
    """One row: the newest timestamp of each form, ``n_values`` and ``n_unparsed``."""
    c = "__loaded_at"
    rows = df.select(F.col(column).cast("string").alias(c))
    reads = {"date_time": f"CASE WHEN {_DATE_TIME.format(c=c)} THEN TRY_CAST({c} AS TIMESTAMP) END"}
    reads |= {name: f"CASE WHEN {test} THEN TRY_CAST(TRY_CAST({iso} AS DATE) AS TIMESTAMP) END" for name, (test, iso) in date_forms(c).items()}
    parsed = rows.select(c, *[F.expr(sql).alias(name) for name, sql in reads.items()])
    return parsed.agg(*[F.max(name).alias(name) for name in reads], F.count(c).alias("n_values"),
                      F.count_if(F.col(c).isNotNull() & F.coalesce(*reads).isNull()).alias("n_unparsed"))


def source_freshness(df: DataFrame, source: str, loaded_at: str, now: str,
                     warn_after_hours: float = 24, error_after_hours: float | None = None) -> DataFrame:
    """One row: source, max_loaded_at, snapshotted_at, age_hours, status, and
    ``unparsed_rows``, the values that are no date."""
    newest = newest_by_form(df, loaded_at)
    forms = [c for c in newest.columns if not c.startswith("n_")]
    snap = F.lit(now).cast("timestamp")
    age = (F.unix_micros(snap) - F.unix_micros(F.col("max_ts"))) / 3.6e9
    status = F.when(F.col("age_hours").isNull(), F.lit("error"))
    if error_after_hours is not None:
        status = status.when(F.col("age_hours") > error_after_hours, F.lit("error"))
    status = status.when(F.col("age_hours") > warn_after_hours, F.lit("warn")).otherwise(F.lit("pass"))
    return (newest.withColumn("max_ts", F.greatest(*forms)).select(
                F.lit(source).alias("source"),
                F.date_format("max_ts", "yyyy-MM-dd HH:mm:ss").alias("max_loaded_at"),
                F.date_format(snap, "yyyy-MM-dd HH:mm:ss").alias("snapshotted_at"),
                age.alias("age_hours"), F.col("n_unparsed").alias("unparsed_rows"))
            .withColumn("status", status))
