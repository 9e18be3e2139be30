"""Hot keys: one claim id, one diagnosis code and one provider each hold a
third of all rows. Results must be whole and exact, and the plans must cut
the hot group down before the shuffle (partial limit / partial aggregate)."""

import contextlib

from pyspark.sql import functions as F

from carelake.operators import dedup, marts, quality, staging
from carelake.sources import seeds

N = 30_000


def skewed_raw(spark):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(N).select(
        F.when(hot, F.lit("HOT")).otherwise(i.cast("string")).alias("CLM_ID"),
        (i % 500).cast("string").alias("BENE_ID"),
        F.when(hot, F.lit("P0")).otherwise((i % 50).cast("string")).alias("PRVDR_NUM"),
        (i % 7).cast("string").alias("CLM_LINE_NUM"),
        F.when(hot, F.lit("D001")).otherwise(F.concat(F.lit("D"), (i % 90).cast("string"))).alias("PRNCPAL_DGNS_CD"),
        F.lit("1").alias("CLM_DRG_CD"),
        (i % 1000).cast("string").alias("CLM_PMT_AMT"),
        (i % 1000 + 5).cast("string").alias("CLM_TOT_CHRG_AMT"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (i % 365).cast("int")), "yyyy-MM-dd")
         .alias("CLM_FROM_DT"),
        F.lit("2021-01-01").alias("CLM_THRU_DT"),
        (i % 60).cast("string").alias("PRVDR_STATE_CD"),
        F.lit("N").alias("ORG_NPI_NUM"),
        F.lit("1").alias("PTNT_DSCHRG_STUS_CD"),
        F.lit("1").alias("CLM_IP_ADMSN_TYPE_CD"),
        i.alias("_ingest_seq"),
    ).repartition(8)


def test_hot_claim_dedup_and_duplicates(spark):
    stg = staging.stg_claims(skewed_raw(spark))
    out = dedup.int_claims_deduplicated(stg)
    assert out.count() == N - N // 3 + 1
    hot = out.where("claim_id = 'HOT'").collect()
    assert len(hot) == 1
    # latest date (2020-12-30 is day 364, ids 364, 729, ... with id % 3 == 0), lowest line, then file order
    best = stg.where("claim_id = 'HOT'").orderBy(F.desc("claim_from_date"), "claim_line_num", "_ingest_seq").first()
    assert hot[0]["_ingest_seq"] == best["_ingest_seq"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2   # partial (before the shuffle) and final

    fact = stg.select("claim_id", "patient_id", "provider_id", "diagnosis_code", "claim_amount",
                      "total_charges", "claim_from_date", "claim_thru_date", "drg_code", "_ingest_seq")
    dup = quality.failed_rows(fact, "duplicate_claim_id")
    assert dup.count() == N // 3 - 1
    assert dup.where("_ingest_seq = 0").count() == 0    # the first HOT row is not a duplicate
    counts = quality.check_counts(fact).first()
    assert counts.duplicate_claim_id == N // 3 - 1


def test_hot_diagnosis_and_provider_marts(spark):
    claims = dedup.int_claims_deduplicated(staging.stg_claims(skewed_raw(spark)))
    icd = spark.createDataFrame([("D001", "hot", "c")], "diagnosis_code string, diagnosis_description string, "
                                                        "diagnosis_category string")
    diag = marts.diagnosis_cost_analysis(claims, icd)
    total = claims.agg(F.sum("claim_amount")).first()[0]
    assert diag.agg(F.sum("total_cost")).first()[0] == total
    assert diag.agg(F.sum("claim_count")).first()[0] == claims.count()
    summary = marts.claims_summary(claims, icd, seeds.state_codes(spark))
    assert summary.agg(F.sum("total_claims")).first()[0] == claims.count()
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_duplicate_rows_broadcast_and_shuffle(spark):
    stg = staging.stg_claims(skewed_raw(spark))
    fact = stg.select("claim_id", "patient_id", "provider_id", "diagnosis_code", "claim_amount",
                      "total_charges", "claim_from_date", "claim_thru_date", "drg_code", "_ingest_seq")
    small = sorted(r._ingest_seq for r in quality.duplicate_rows(fact).collect())
    with forced_shuffle(spark):
        big = quality.duplicate_rows(fact)
        assert "BroadcastExchange" not in big._jdf.queryExecution().executedPlan().toString()
        assert sorted(r._ingest_seq for r in big.collect()) == small
    assert len(small) == N // 3 - 1


@contextlib.contextmanager
def forced_shuffle(spark, *off):
    """No broadcast by size; the switches ``off`` are off."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} | {k: "false" for k in off}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_code_joins_by_shuffle_give_the_same_rows(spark, sf_small):
    """J1 and J4 with a code list that is too big to broadcast."""
    from carelake.contracts import queries as Q
    build = lambda: {n: Q.QUERIES[n](spark, sf_small) for n in (
        "mart_claims_summary", "mart_diagnosis_cost_analysis", "star_fact_claims", "star_dim_diagnosis")}
    rows = lambda frames: {n: sorted(map(str, df.collect())) for n, df in frames.items()}
    usual = rows(build())
    with forced_shuffle(spark):
        frames = build()
        assert all("SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString() for df in frames.values())
        assert rows(frames) == usual
