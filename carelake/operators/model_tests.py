"""Declarative column tests over the models, reported as a table.

Each model is scanned once for all of its tests. The results are assembled with ``unionByName`` into (model, column_name, test,
failures, status).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The declared tests, model -> [(column, test), ...].
MODEL_TESTS = {
    "stg_claims": [("claim_id", "not_null"), ("patient_id", "not_null"),
                   ("provider_id", "not_null"), ("claim_amount", "not_null")],
    "int_claims_deduplicated": [("claim_id", "unique"), ("claim_id", "not_null")],
    "mart_claims_summary": [("claim_month", "not_null"), ("total_claims", "not_null"),
                            ("total_paid", "not_null")],
    "mart_provider_performance": [("provider_id", "not_null")],
    "mart_diagnosis_cost_analysis": [("diagnosis_code", "not_null")],
}


def model_failures(df: DataFrame, model: str, specs: list[tuple[str, str]]) -> DataFrame:
    """All tests of one model from one scan. Not-null tests are conditional
    counts. A unique test groups by its column first (partially aggregated, so a
    hot value is cheap) and carries the other tests' counts along; a model has
    at most one unique column."""
    unique = [c for c, t in specs if t == "unique"]
    if len(unique) > 1:
        raise ValueError(f"{model}: more than one unique test")
    nulls = {f"n{i}": F.count_if(F.col(c).isNull()) for i, (c, t) in enumerate(specs) if t == "not_null"}
    if unique:
        per_value = df.groupBy(F.col(unique[0]).alias("__value")).agg(
            F.count(F.lit(1)).alias("__n"), *[c.alias(k) for k, c in nulls.items()])
        counts = per_value.agg(
            F.count_if(F.col("__value").isNotNull() & (F.col("__n") > 1)).alias("u"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in nulls])
    else:
        counts = df.agg(*[c.alias(k) for k, c in nulls.items()])
    found = ", ".join(f"'{c}', '{t}', cast({'u' if t == 'unique' else f'n{i}'} as bigint)" for i, (c, t) in enumerate(specs))
    return counts.selectExpr(f"stack({len(specs)}, {found}) as (column_name, test, failures)").select(
        F.lit(model).alias("model"), "column_name", "test", "failures")


def run_model_tests(models: dict[str, DataFrame], tests: dict | None = None) -> DataFrame:
    """The test report over ``models`` (name -> DataFrame)."""
    tests = tests or MODEL_TESTS
    parts = [model_failures(models[m], m, specs) for m, specs in tests.items() if m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """The number of non-null values that occur more than once (one row). A table
    bucketed by the column is not shuffled for it."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
    return per_value.agg(F.count_if(F.col("__n") > 1).alias("failures"))


def report_of(spark: SparkSession, failures: dict[tuple[str, str, str], int]) -> DataFrame:
    """The report from failing rows that were counted on the way, by (model, column, test)."""
    rows = ", ".join(f"('{m}', '{c}', '{t}', {n}L, '{'fail' if n else 'pass'}')" for (m, c, t), n in failures.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(model, column_name, test, failures, status)")


def failed_tests(report: DataFrame) -> list[tuple[str, str, str, int]]:
    """The failing tests (a small report read back on the driver)."""
    return [(r["model"], r["column_name"], r["test"], r["failures"])
            for r in report.where(F.col("status") == "fail").collect()]


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """The values of ``column`` that occur more than once, with their number
    of copies (NULLs ignored): the detail behind a failed unique test."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1))
