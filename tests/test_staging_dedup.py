"""Staging (P1-P5) and the dedup window (W1) on hand-made edge frames."""

import pytest
from pyspark.sql import Row

from carelake.operators import dedup, staging
from carelake.schemas import RAW_CLAIM_COLUMNS


def raw_claims(spark, rows):
    """Bronze rows: dicts of the raw columns that matter, the rest filled."""
    base = {c: None for c in RAW_CLAIM_COLUMNS}
    base.update(CLM_ID="C1", BENE_ID="B1", PRVDR_NUM="P1", CLM_LINE_NUM="1",
                PRNCPAL_DGNS_CD="D001", CLM_DRG_CD="470", CLM_PMT_AMT="10.0",
                CLM_TOT_CHRG_AMT="20.0", CLM_FROM_DT="2020-01-01", CLM_THRU_DT="2020-01-02",
                PRVDR_STATE_CD="10", ORG_NPI_NUM="N1", PTNT_DSCHRG_STUS_CD="1",
                CLM_IP_ADMSN_TYPE_CD="1")
    data = [{**base, **r} for r in rows]
    return spark.createDataFrame([Row(**d) for d in data],
                                 schema=", ".join(f"{c} string" for c in RAW_CLAIM_COLUMNS))


def test_stg_claims_types_and_filters(spark):
    df = raw_claims(spark, [
        {},
        {"CLM_ID": None},
        {"BENE_ID": None},
        {"PRVDR_NUM": None},
        {"CLM_PMT_AMT": None},
        {"CLM_PMT_AMT": "-1"},
        {"CLM_PMT_AMT": "NaN"},
        {"CLM_PMT_AMT": "0"},
    ])
    out = staging.stg_claims(df)
    assert [f.dataType.simpleString() for f in out.schema.fields][:8] == [
        "string", "string", "string", "bigint", "string", "string", "double", "double"]
    amounts = sorted(r.claim_amount for r in out.collect())
    assert amounts == [0.0, 10.0]


def test_stg_claims_bad_number_raises(spark):
    df = raw_claims(spark, [{"CLM_PMT_AMT": "abc"}])
    with pytest.raises(Exception):
        staging.stg_claims(df).collect()


def test_stg_icd_codes(spark):
    icd = spark.createDataFrame(
        [(" d001 ", " desc ", " cat "), (None, "x", "y"), ("", "e", "f"), ("\tA02\n", "t\t", "\tc")],
        "code string, description string, category string")
    rows = sorted(staging.stg_icd_codes(icd).collect(), key=lambda r: r.diagnosis_code)
    # a warehouse TRIM removes tabs and newlines too, not only spaces
    assert [tuple(r) for r in rows] == [("", "e", "f"), ("A02", "t", "c"), ("D001", "desc", "cat")]


@pytest.mark.parametrize("rows, kept_line", [
    ([{"CLM_LINE_NUM": "2"}, {"CLM_LINE_NUM": "1"}], 1),
    ([{"CLM_LINE_NUM": "1"}, {"CLM_LINE_NUM": "3", "CLM_FROM_DT": "2020-02-01"}], 3),
    ([{"CLM_LINE_NUM": "1"}, {"CLM_LINE_NUM": None}], None),
])
def test_dedup_order(spark, rows, kept_line):
    out = dedup.int_claims_deduplicated(staging.stg_claims(raw_claims(spark, rows))).collect()
    assert len(out) == 1 and out[0].claim_line_num == kept_line


def test_dedup_plan_limits_before_shuffle(spark, sf_small):
    from carelake.sources import fixtures
    df = dedup.int_claims_deduplicated(staging.stg_claims(fixtures.claims_raw(spark, sf_small)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
