"""The three analytical marts.

Plan shape, chosen for scale:

* The state seed (53 rows, fixed) is always broadcast: the state lookup
  never shuffles claims.
* The ICD code list has no fixed size bound, so claims are aggregated
  *before* they meet it. The summary and diagnosis marts first reduce the
  claims to one partial row per (month, raw state code, diagnosis) or per
  diagnosis with map-side partial aggregation, then join the much smaller
  partial table to the codes, then finish the aggregation. A hot diagnosis
  code is collapsed by the partial aggregation instead of landing in one
  join task, and the join is cheap whichever strategy AQE picks for it.
* Outputs carry the column dictionary as ``comment`` metadata.
* Partial rows carry sums and counts (and the second central moment for
  the standard deviation), so re-aggregating after the code join gives the
  same result as aggregating the joined rows -- including the fan-out of a
  code listed twice, which multiplies its claims like the row join does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import month_of, safe_bigint
from carelake.operators.ranking import global_rank
from carelake.schemas import (MART_CLAIMS_SUMMARY, MART_DIAGNOSIS_COST, MART_PROVIDER_PERFORMANCE,
                              with_comments)
from carelake.sources.seeds import with_state_name


def _icd_lookup(icd: DataFrame) -> DataFrame:
    return icd.select("diagnosis_code", "diagnosis_description", "diagnosis_category")


def _ratio(num, den):
    return num / F.nullif(den, F.lit(0))


def claims_summary(claims: DataFrame, icd: DataFrame, states: DataFrame) -> DataFrame:
    """A1 ``mart_claims_summary``: per month, state name, diagnosis code,
    description and category -- claim count, paid, charged, mean paid and
    SUM(charges - paid) (a row with NULL charges adds nothing to it)."""
    partial = (claims
               .groupBy(month_of("claim_from_date").alias("claim_month"),
                        "provider_state_code", "diagnosis_code")
               .agg(F.count("claim_id").alias("n_claims"),
                    F.sum("claim_amount").alias("paid"),
                    F.count("claim_amount").alias("n_paid"),
                    F.sum("total_charges").alias("charged"),
                    F.sum(F.col("total_charges") - F.col("claim_amount")).alias("denied")))
    named = with_state_name(partial, safe_bigint("provider_state_code"), states, "state")
    joined = named.join(_icd_lookup(icd), "diagnosis_code", "left")
    mart = (joined
            .groupBy("claim_month", "state", "diagnosis_code",
                     "diagnosis_description", "diagnosis_category")
            .agg(F.sum("n_claims").alias("total_claims"),
                 F.sum("paid").alias("total_paid"),
                 F.sum("charged").alias("total_charged"),
                 _ratio(F.sum("paid"), F.sum("n_paid")).alias("avg_paid_per_claim"),
                 F.sum("denied").alias("total_denied_amount")))
    return with_comments(mart, MART_CLAIMS_SUMMARY)


def provider_performance(claims: DataFrame, states: DataFrame) -> DataFrame:
    """A2 ``mart_provider_performance``: per provider, NPI and state name --
    counts, sums, ROUND(paid / NULLIF(charged, 0) * 100, 2), mean, max, min.

    The state lookup is a broadcast join in the scan stage, so the only
    shuffle is the aggregation's, with map-side partial aggregation."""
    named = with_state_name(claims, safe_bigint("provider_state_code"), states, "provider_state")
    paid, charged = F.sum("claim_amount"), F.sum("total_charges")
    return with_comments(named.groupBy("provider_id", "npi_number", "provider_state")
            .agg(F.count("claim_id").alias("total_claims"),
                 paid.alias("total_paid"),
                 charged.alias("total_charged"),
                 F.round(_ratio(paid, charged) * 100, 2).alias("payment_ratio_pct"),
                 F.avg("claim_amount").alias("avg_claim_paid"),
                 F.max("claim_amount").alias("max_claim"),
                 F.min("claim_amount").alias("min_claim")), MART_PROVIDER_PERFORMANCE)


def diagnosis_cost_analysis(claims: DataFrame, icd: DataFrame) -> DataFrame:
    """A3 ``mart_diagnosis_cost_analysis``: per diagnosis code, description
    and category -- count, sum, mean, max, min and sample standard deviation
    (NULL for a single claim)."""
    amount = F.col("claim_amount")
    partial = (claims.groupBy("diagnosis_code")
               .agg(F.count("claim_id").alias("n_claims"),
                    F.sum(amount).alias("paid"),
                    F.count(amount).alias("n_paid"),
                    F.max(amount).alias("hi"),
                    F.min(amount).alias("lo"),
                    (F.var_pop(amount) * F.count(amount)).alias("m2")))
    joined = partial.join(_icd_lookup(icd), "diagnosis_code", "left")
    # Every partial row of one output group is a copy of the same
    # per-code row (the code is a group key), so their means agree and the
    # pooled second moment is the plain sum of the parts.
    n = F.sum("n_paid")
    return with_comments(joined.groupBy("diagnosis_code", "diagnosis_description", "diagnosis_category")
            .agg(F.sum("n_claims").alias("claim_count"),
                 F.sum("paid").alias("total_cost"),
                 _ratio(F.sum("paid"), n).alias("avg_cost_per_claim"),
                 F.max("hi").alias("max_claim"),
                 F.min("lo").alias("min_claim"),
                 F.when(n > 1, F.sqrt(F.greatest(F.sum("m2"), F.lit(0.0)) / (n - 1))).alias("cost_stddev")),
        MART_DIAGNOSIS_COST)


def cost_order() -> list:
    """Highest total cost first; the group key breaks ties."""
    return [F.col("total_cost").desc_nulls_last(), F.col("diagnosis_code").asc_nulls_first(),
            F.col("diagnosis_description").asc_nulls_first(), F.col("diagnosis_category").asc_nulls_first()]


def order_by_cost(mart: DataFrame) -> DataFrame:
    """The diagnosis mart as presented, highest total cost first (only
    on read; the stored mart is unordered)."""
    return mart.orderBy(*cost_order())


def ranked_by_cost(mart: DataFrame) -> DataFrame:
    """T1 as a column: every row of the diagnosis mart with its ``rank`` in that order."""
    return global_rank(mart, cost_order())
