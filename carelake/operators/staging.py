"""Staging over the raw claims and the ICD code list, as DataFrames and as
the SQL text of catalog views (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import iso_date_sql, strip_ws_sql
from carelake.schemas import DATE_COLUMNS, RAW_TO_STAGED

# The rows that staging keeps, on the raw values: NULL and NaN payments go.
CLAIMS_KEPT = ("CLM_ID IS NOT NULL AND BENE_ID IS NOT NULL AND PRVDR_NUM IS NOT NULL "
               "AND CAST(CLM_PMT_AMT AS DOUBLE) >= 0 AND NOT isnan(CAST(CLM_PMT_AMT AS DOUBLE))")
# The same where nothing may fail: a malformed payment is not kept.
CLAIMS_COUNTED = "coalesce(" + CLAIMS_KEPT.replace("CAST(", "TRY_CAST(") + ", false)"
CODES_KEPT = "code IS NOT NULL"


def claims_columns(iso_dates: bool = True) -> list[str]:
    value = lambda raw: iso_date_sql(raw) if iso_dates and raw in DATE_COLUMNS else raw
    return [f"CAST({value(raw)} AS {kind.simpleString().upper()}) AS {staged}" for raw, staged, kind in RAW_TO_STAGED]


def codes_columns() -> list[str]:
    return [f"{strip_ws_sql('upper(code)')} AS diagnosis_code", f"{strip_ws_sql('description')} AS diagnosis_description",
            f"{strip_ws_sql('category')} AS diagnosis_category"]


def claims_view(source: str) -> str:
    """SQL of ``stg_claims`` over a table of raw claims."""
    return f"SELECT {', '.join(claims_columns())} FROM {source} WHERE {CLAIMS_KEPT}"


def codes_view(source: str) -> str:
    """SQL of ``stg_icd_codes`` over a table of raw codes."""
    return f"SELECT {', '.join(codes_columns())} FROM {source} WHERE {CODES_KEPT}"


def _staged(raw: DataFrame, kept: str, columns: list[str]) -> DataFrame:
    hidden = [c for c in raw.columns if c.startswith("_")]
    return raw.where(kept).select(*[F.expr(c) for c in columns], *hidden)


def stg_claims(claims_raw: DataFrame, iso_dates: bool = True) -> DataFrame:
    """Rename and strictly cast the 14 used columns; keep rows with a
    claim, patient and provider id and a non-negative payment.

    The filter tests the raw values, so a NULL payment is dropped. Casts are
    ANSI: malformed numbers raise, as a warehouse CAST does. With ``iso_dates``
    a date given as yyyy-MM-dd, yyyyMMdd or dd-MMM-yyyy becomes ISO text, so a
    month is ``SUBSTR(date, 1, 7)`` and date order is text order. Hidden
    ``_``-prefixed columns (the file-order key) are carried along.
    """
    return _staged(claims_raw, CLAIMS_KEPT, claims_columns(iso_dates))


def stg_icd_codes(icd_raw: DataFrame) -> DataFrame:
    """Upper-cased, trimmed code; trimmed description and category.
    Trimming removes all surrounding whitespace (tabs too), like the
    warehouse TRIM. Rows with a NULL code are dropped (an empty code
    survives). Codes are not de-duplicated: a doubled code fans out in the
    joins that use it."""
    return _staged(icd_raw, CODES_KEPT, codes_columns())


def drop_hidden(df: DataFrame) -> DataFrame:
    """Remove the ``_``-prefixed bookkeeping columns from an output."""
    return df.drop(*[c for c in df.columns if c.startswith("_")])
