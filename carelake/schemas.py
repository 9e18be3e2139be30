"""Column names and output schemas of the claims model."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

# Raw (bronze) column -> (staged name, staged type), in staged column order.
RAW_TO_STAGED = [
    ("CLM_ID", "claim_id", S),
    ("BENE_ID", "patient_id", S),
    ("PRVDR_NUM", "provider_id", S),
    ("CLM_LINE_NUM", "claim_line_num", L),
    ("PRNCPAL_DGNS_CD", "diagnosis_code", S),
    ("CLM_DRG_CD", "drg_code", S),
    ("CLM_PMT_AMT", "claim_amount", D),
    ("CLM_TOT_CHRG_AMT", "total_charges", D),
    ("CLM_FROM_DT", "claim_from_date", S),
    ("CLM_THRU_DT", "claim_thru_date", S),
    ("PRVDR_STATE_CD", "provider_state_code", S),
    ("ORG_NPI_NUM", "npi_number", S),
    ("PTNT_DSCHRG_STUS_CD", "discharge_status", S),
    ("CLM_IP_ADMSN_TYPE_CD", "admission_type", S),
]
RAW_CLAIM_COLUMNS = [raw for raw, _, _ in RAW_TO_STAGED]
DATE_COLUMNS = ["CLM_FROM_DT", "CLM_THRU_DT"]

# The legacy (v1) star ETL uses the same columns minus the line number, and
# calls the state column provider_state.
V1_RENAMES = {raw: staged for raw, staged, _ in RAW_TO_STAGED if raw != "CLM_LINE_NUM"}
V1_RENAMES["PRVDR_STATE_CD"] = "provider_state"

# Headerless six-column layout of the ICD-10 code list.
ICD_SOURCE_COLUMNS = [
    "category_code", "sub_code", "icd10_code",
    "short_description", "long_description", "category",
]
ICD_SOURCE_SCHEMA = T.StructType([T.StructField(c, S) for c in ICD_SOURCE_COLUMNS])

def _struct(fields, comments=None, not_null=()):
    comments = comments or {}
    return T.StructType([
        T.StructField(name, typ, name not in not_null,
                      {"comment": comments[name]} if name in comments else {})
        for name, typ in fields
    ])



MART_CLAIMS_SUMMARY = _struct(
    [("claim_month", S), ("state", S), ("diagnosis_code", S),
     ("diagnosis_description", S), ("diagnosis_category", S), ("total_claims", L),
     ("total_paid", D), ("total_charged", D), ("avg_paid_per_claim", D),
     ("total_denied_amount", D)],
    {
        "claim_month": "claim month as YYYY-MM",
        "state": "provider state name, 'Unknown' when the code does not map",
        "diagnosis_code": "principal diagnosis code as billed",
        "diagnosis_description": "diagnosis text from the code list",
        "diagnosis_category": "diagnosis category from the code list",
        "total_claims": "claims in the group",
        "total_paid": "sum of paid amounts",
        "total_charged": "sum of charged amounts",
        "avg_paid_per_claim": "mean paid amount",
        "total_denied_amount": "sum over claims of charged minus paid",
    },
)
MART_PROVIDER_PERFORMANCE = _struct(
    [("provider_id", S), ("npi_number", S), ("provider_state", S), ("total_claims", L),
     ("total_paid", D), ("total_charged", D), ("payment_ratio_pct", D),
     ("avg_claim_paid", D), ("max_claim", D), ("min_claim", D)],
    {
        "provider_id": "provider identifier",
        "npi_number": "national provider identifier",
        "provider_state": "provider state name",
        "total_claims": "claims filed by the provider",
        "total_paid": "sum of paid amounts",
        "total_charged": "sum of charged amounts",
        "payment_ratio_pct": "paid / charged * 100, 2 decimals, NULL when nothing charged",
        "avg_claim_paid": "mean paid amount",
        "max_claim": "largest paid amount",
        "min_claim": "smallest paid amount",
    },
)
MART_DIAGNOSIS_COST = _struct(
    [("diagnosis_code", S), ("diagnosis_description", S), ("diagnosis_category", S),
     ("claim_count", L), ("total_cost", D), ("avg_cost_per_claim", D),
     ("max_claim", D), ("min_claim", D), ("cost_stddev", D)],
    {
        "diagnosis_code": "principal diagnosis code as billed",
        "diagnosis_description": "diagnosis text from the code list",
        "diagnosis_category": "diagnosis category from the code list",
        "claim_count": "claims with the diagnosis",
        "total_cost": "sum of paid amounts",
        "avg_cost_per_claim": "mean paid amount",
        "max_claim": "largest paid amount",
        "min_claim": "smallest paid amount",
        "cost_stddev": "sample standard deviation of paid amounts",
    },
)

# Star schema (keys declared NOT NULL).
DIM_PATIENT = _struct([("patient_id", S), ("state", S), ("discharge_status", S), ("admission_type", S)],
                      not_null=("patient_id",))
DIM_PROVIDER = _struct([("provider_id", S), ("provider_state", S), ("npi_number", S)],
                       not_null=("provider_id",))
DIM_DIAGNOSIS = _struct([("diagnosis_code", S), ("description", S)], not_null=("diagnosis_code",))
FACT_CLAIMS = _struct(
    [("claim_id", S), ("patient_id", S), ("provider_id", S), ("diagnosis_code", S),
     ("claim_amount", D), ("total_charges", D), ("claim_from_date", S),
     ("claim_thru_date", S), ("drg_code", S)],
    not_null=("claim_id",),
)
STAR_TABLES = {
    "dim_patient": DIM_PATIENT,
    "dim_provider": DIM_PROVIDER,
    "dim_diagnosis": DIM_DIAGNOSIS,
    "fact_claims": FACT_CLAIMS,
}

# Tables the SQL audit lets through.
ALLOWED_TABLES = ("mart_claims_summary", "mart_provider_performance", "mart_diagnosis_cost_analysis")


def with_comments(df, schema: T.StructType):
    """Attach the schema's column comments to ``df`` (no data change)."""
    by_name = {f.name: f.metadata for f in schema.fields}
    return df.select(*[
        df[c].alias(c, metadata=by_name[c]) if by_name.get(c) else df[c]
        for c in df.columns
    ])
