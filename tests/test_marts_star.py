"""Marts (A1-A11, J1, J2) and the legacy star ETL on edge frames."""

import math

from pyspark.sql import functions as F

from carelake.operators import marts, star
from carelake.sources import seeds

CLAIMS = ("claim_id string, patient_id string, provider_id string, claim_line_num bigint, "
          "diagnosis_code string, drg_code string, claim_amount double, total_charges double, "
          "claim_from_date string, claim_thru_date string, provider_state_code string, "
          "npi_number string, discharge_status string, admission_type string")


def claims(spark, rows):
    full = []
    for i, r in enumerate(rows):
        d = dict(claim_id=f"C{i}", patient_id="B", provider_id="P", claim_line_num=1,
                 diagnosis_code="D001", drg_code="1", claim_amount=1.0, total_charges=2.0,
                 claim_from_date="2020-01-15", claim_thru_date="2020-01-16",
                 provider_state_code="10", npi_number="N", discharge_status="1", admission_type="1")
        d.update(r)
        full.append(d)
    return spark.createDataFrame(full, CLAIMS)


def icd(spark, rows=(("D001", "first", "cat"),)):
    return spark.createDataFrame(list(rows), "diagnosis_code string, diagnosis_description string, "
                                             "diagnosis_category string")


def test_state_lookup_cases(spark):
    c = claims(spark, [{"provider_state_code": s, "provider_id": f"P{i}"}
                       for i, s in enumerate(["10", " 10 ", "XX", None, "54"])])
    out = marts.provider_performance(c, seeds.state_codes(spark))
    got = {r.provider_id: r.provider_state for r in out.collect()}
    assert got == {"P0": "Florida", "P1": "Florida", "P2": "Unknown", "P3": "Unknown", "P4": "Unknown"}


def test_asymmetric_trim_no_match(spark):
    out = marts.diagnosis_cost_analysis(claims(spark, [{"diagnosis_code": "d001"}]), icd(spark))
    r = out.collect()[0]
    assert r.diagnosis_code == "d001" and r.diagnosis_description is None


def test_ratio_null_when_nothing_charged(spark):
    out = marts.provider_performance(claims(spark, [{"total_charges": 0.0}]), seeds.state_codes(spark))
    assert out.collect()[0].payment_ratio_pct is None


def test_single_claim_stddev_null_and_fanout(spark):
    codes = icd(spark, [("D001", "a", "x"), ("D001", "a", "x"), ("D001", "b", "x")])
    c = claims(spark, [{"claim_amount": 1.0}, {"claim_amount": 3.0}])
    out = {(r.diagnosis_description): r for r in marts.diagnosis_cost_analysis(c, codes).collect()}
    # "a" is listed twice: every claim counts twice, as in the row join.
    assert out["a"].claim_count == 4 and out["a"].total_cost == 8.0
    assert math.isclose(out["a"].cost_stddev, math.sqrt(4 / 3))
    assert out["b"].claim_count == 2 and math.isclose(out["b"].cost_stddev, math.sqrt(2))
    one = marts.diagnosis_cost_analysis(claims(spark, [{}]), icd(spark)).collect()[0]
    assert one.cost_stddev is None


def test_denied_amount_skips_null_charges(spark):
    c = claims(spark, [{"total_charges": 10.0, "claim_amount": 1.0},
                       {"total_charges": None, "claim_amount": 2.0}])
    r = marts.claims_summary(c, icd(spark), seeds.state_codes(spark)).collect()[0]
    assert r.total_denied_amount == 9.0 and r.total_paid == 3.0 and r.total_charged == 10.0
    assert r.claim_month == "2020-01" and r.state == "Florida" and r.avg_paid_per_claim == 1.5


def test_summary_plan_broadcasts_states(spark, sf_small):
    from carelake.contracts.queries import _summary
    plan = _summary(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


RAW_V1 = ("CLM_ID string, BENE_ID string, PRVDR_NUM string, PRNCPAL_DGNS_CD string, CLM_PMT_AMT string, "
          "CLM_TOT_CHRG_AMT string, CLM_FROM_DT string, CLM_THRU_DT string, CLM_DRG_CD string, "
          "PRVDR_STATE_CD string, ORG_NPI_NUM string, PTNT_DSCHRG_STUS_CD string, "
          "CLM_IP_ADMSN_TYPE_CD string, _ingest_seq bigint")


def test_v1_fills_and_coerces(spark):
    raw = spark.createDataFrame([
        ("A", "B", "P", None, "abc", None, "2020-01-01", "2020-01-02", None, "5.0", "N", "1", "1", 1),
        ("A", "B", "P", "D001", "7", "8", "2020-01-01", "2020-01-02", "470", " 05 ", "N", "1", "1", 2),
        ("C", None, "P", "D001", "7", "8", "2020-01-01", "2020-01-02", "470", "5", "N", "1", "1", 3),
        ("E", "B", "P", " D001\t", "-3", "8", "2020-01-01", "2020-01-02", "470", "5.5", "N", "1", "1", 4),
    ], RAW_V1)
    codes = spark.createDataFrame([(" D001 ", "Desc", "cat", 1)],
                                  "code string, description string, category string, _icd_seq bigint")
    fact, pat, prov, diag = star.build_star(raw, codes, seeds.state_codes(spark))
    rows = {r.claim_id: r for r in fact.collect()}
    assert set(rows) == {"A", "E"}            # C dropped (no patient), A kept once (first)
    assert rows["A"].claim_amount == 0.0 and rows["A"].total_charges == 0.0
    assert rows["A"].diagnosis_code == "UNKNOWN" and rows["A"].drg_code == "0"
    assert rows["E"].claim_amount == -3.0 and rows["E"].diagnosis_code == "D001"
    d = {r.diagnosis_code: r.description for r in diag.collect()}
    assert d == {"UNKNOWN": "Unknown diagnosis", "D001": "Desc"}
    states = {r.provider_id: r.provider_state for r in prov.collect()}
    assert states == {"P": "California"}       # first row of P is claim A ('5.0' maps)
    assert fact.schema.fieldNames() == ["claim_id", "patient_id", "provider_id", "diagnosis_code",
                                        "claim_amount", "total_charges", "claim_from_date",
                                        "claim_thru_date", "drg_code"]
    assert pat.where(F.col("state") == "California").count() == 1


def test_marts_carry_column_comments(spark):
    out = marts.provider_performance(claims(spark, [{}]), seeds.state_codes(spark))
    meta = {f.name: f.metadata.get("comment") for f in out.schema.fields}
    assert meta["payment_ratio_pct"].startswith("paid / charged")
    assert out.columns == ["provider_id", "npi_number", "provider_state", "total_claims", "total_paid",
                           "total_charged", "payment_ratio_pct", "avg_claim_paid", "max_claim", "min_claim"]
