"""The standing questions, KPIs and row-count report.

Top-k questions end their ORDER BY in the group key so ties are stable,
and use ``orderBy(...).limit(k)``, which Spark plans as a
TakeOrderedAndProject: each partition keeps its own top k, only those rows
reach the final merge -- no global sort of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.columns import month_of, safe_bigint
from carelake.sources.seeds import with_state_name


# ---------------------------------------------------------------- KPIs

def kpi_totals(claims: DataFrame) -> DataFrame:
    """Total spend, unique claims and mean cost per claim.

    On the de-duplicated claims the distinct count needs no extra shuffle:
    the dedup window already hash-partitions the rows by claim_id."""
    return claims.agg(
        F.sum("claim_amount").alias("total_spend"),
        F.count_distinct("claim_id").alias("unique_claims"),
        F.avg("claim_amount").alias("avg_cost_per_claim"),
    )


def kpi_top_state(claims: DataFrame, states: DataFrame) -> DataFrame:
    """The provider state with the most claims (ties -> by name)."""
    named = with_state_name(claims, safe_bigint("provider_state_code"), states, "state")
    return (named.groupBy("state").agg(F.count("claim_id").alias("total_claims"))
                 .orderBy(F.col("total_claims").desc(), F.col("state").asc())
                 .limit(1))


def kpi_yearly_cost(claims: DataFrame) -> DataFrame:
    """Paid amount and claims per calendar year of the from-date."""
    return (claims.groupBy(F.substring(month_of("claim_from_date"), 1, 4).alias("claim_year"))
                  .agg(F.sum("claim_amount").alias("total_paid"),
                       F.count("claim_id").alias("total_claims")))


def row_counts(steps: dict[str, DataFrame]) -> DataFrame:
    """(step, row_count) for each named relation, as one DataFrame.

    Identical sub-plans (the same scan or shuffle feeding several steps)
    are reused by Spark within the single query."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("step"), "row_count")
             for name, df in steps.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counted_rows(spark: SparkSession, steps: dict[str, int]) -> DataFrame:
    """A15 from counts that the writes of a run made themselves."""
    rows = ", ".join(f"('{step}', {n}L)" for step, n in steps.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(step, row_count)")


# ---------------------------------------------------------- questions

def top_state_paid(summary: DataFrame) -> DataFrame:
    """The state with the highest total paid."""
    return (summary.groupBy("state").agg(F.sum("total_paid").alias("total_paid"))
                   .orderBy(F.col("total_paid").desc_nulls_last(), F.col("state").asc())
                   .limit(1))


def top_diagnoses_by_avg_cost(diagnosis: DataFrame, k: int = 5) -> DataFrame:
    """The k diagnosis codes with the highest mean cost per claim."""
    return (diagnosis.select("diagnosis_code", "diagnosis_description", "avg_cost_per_claim")
                     .orderBy(F.col("avg_cost_per_claim").desc_nulls_last(),
                              F.col("diagnosis_code").asc_nulls_first(),
                              F.col("diagnosis_description").asc_nulls_first())
                     .limit(k))


def lowest_payment_ratio(providers: DataFrame) -> DataFrame:
    """T4: the provider with the lowest payment ratio (providers without a
    ratio are skipped)."""
    return (providers.where(F.col("payment_ratio_pct").isNotNull())
                     .select("provider_id", "npi_number", "provider_state", "payment_ratio_pct")
                     .orderBy(F.col("payment_ratio_pct").asc(), F.col("provider_id").asc(),
                              F.col("npi_number").asc(), F.col("provider_state").asc())
                     .limit(1))


def summary_top_paid(summary: DataFrame, k: int = 5) -> DataFrame:
    """T5: summary rows with the highest total paid."""
    return (summary.orderBy(F.col("total_paid").desc_nulls_last(), F.col("claim_month").asc_nulls_first(),
                            F.col("state").asc_nulls_first(), F.col("diagnosis_code").asc_nulls_first(),
                            F.col("diagnosis_description").asc_nulls_first(),
                            F.col("diagnosis_category").asc_nulls_first())
                   .select("claim_month", "state", "diagnosis_code", "total_paid")
                   .limit(k))


def providers_top_paid(providers: DataFrame, k: int = 100) -> DataFrame:
    """Providers by total paid (the default row cap of 100)."""
    return (providers.orderBy(F.col("total_paid").desc_nulls_last(), F.col("provider_id").asc_nulls_first(),
                              F.col("npi_number").asc_nulls_first(), F.col("provider_state").asc_nulls_first())
                     .select("provider_id", "npi_number", "total_paid")
                     .limit(k))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Any n rows of a table (which rows is unspecified)."""
    return df.limit(n)
