"""The legacy star-schema ETL (one fact, three dims).

Order of steps matters and is kept where it shows in the rows: select -> rename ->
drop null ids -> keep first row per claim -> state names -> fill and coerce -> ICD join
-> split. Null ids are dropped before the dedup, and the dedup comes before
the ICD join, so a code listed twice in the code list re-creates duplicate
claim rows in the fact table (the quality gate's duplicate check finds them).

"Keep first" means file order: every input carries a file-order key
(``_ingest_seq`` for claims, ``_icd_seq`` for the code list), because a
distributed scan does not preserve row order by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import integral_key, number_or_zero, strip_ws, strip_ws_sql
from carelake.operators.dedup import keep_first
from carelake.schemas import (DIM_DIAGNOSIS, DIM_PATIENT, DIM_PROVIDER, FACT_CLAIMS,
                              V1_RENAMES)
from carelake.sources.claims_csv import INGEST_ORDER
from carelake.sources.icd_csv import ICD_INGEST_ORDER
from carelake.sources.seeds import with_state_name

UNKNOWN_DIAGNOSIS_CODE = "UNKNOWN"
UNKNOWN_DIAGNOSIS_TEXT = "Unknown diagnosis"
IDS = ["claim_id", "patient_id", "provider_id"]   # a row without one of them is dropped


def used_columns(claims_raw: DataFrame) -> list[str]:
    """The raw columns that the ETL reads, and the file order."""
    return [*V1_RENAMES, *[c for c in (INGEST_ORDER,) if c in claims_raw.columns]]


def select_and_rename(claims_raw: DataFrame) -> DataFrame:
    """The 13 columns (no line number), renamed; file order kept."""
    cols = [F.col(raw).alias(new) for raw, new in V1_RENAMES.items()]
    if INGEST_ORDER in claims_raw.columns:
        cols.append(F.col(INGEST_ORDER))
    return claims_raw.select(*cols)


def map_state_names(df: DataFrame, states: DataFrame) -> DataFrame:
    """Numeric state code -> name, read leniently ('5', ' 05 ', '5.0'
    all map), anything else -> 'Unknown'. Broadcast lookup, no shuffle."""
    return with_state_name(df, integral_key("provider_state"), states, "provider_state")


def clean_values(df: DataFrame) -> DataFrame:
    """Fill and coerce.

    Amounts: NULL, unparsable or NaN -> 0.0 (negatives stay). Diagnosis
    NULL -> 'UNKNOWN'. DRG code NULL -> '0', otherwise its source text.
    Rows without claim, patient or provider id are dropped. Dates stay as
    text (NULL stays NULL).
    """
    return (df.dropna(subset=IDS)
              .withColumns({
                  "claim_amount": number_or_zero("claim_amount"),
                  "total_charges": number_or_zero("total_charges"),
                  "diagnosis_code": F.coalesce(F.col("diagnosis_code"), F.lit(UNKNOWN_DIAGNOSIS_CODE)),
                  "drg_code": F.coalesce(F.col("drg_code").cast("string"), F.lit("0")),
                  "claim_from_date": F.col("claim_from_date").cast("string"),
                  "claim_thru_date": F.col("claim_thru_date").cast("string"),
              }))


def icd_descriptions(icd_raw: DataFrame) -> DataFrame:
    """The code list as the legacy join sees it: (diagnosis_code, description),
    whitespace-stripped but not upper-cased."""
    cols = [strip_ws("code").alias("diagnosis_code"), F.col("description")]
    if ICD_INGEST_ORDER in icd_raw.columns:
        cols.append(F.col(ICD_INGEST_ORDER))
    return icd_raw.select(*cols)


# Codes that hold more than a HOT_SHARE-th of the rows are spread by broadcast.
HOT_SHARE = 100
HOT_CODES = 200          # found by the sketch at most; those over HOT_SHARE are fewer
HOT_ENTRIES = 100_000    # list entries broadcast at most


def frequent_codes() -> Column:
    """A sketch of the most frequent stripped codes, for the write of the claims:
    a mergeable aggregate of bounded size, exact where codes are few."""
    return F.expr(f"approx_top_k({strip_ws_sql('diagnosis_code')}, {HOT_CODES}, {50 * HOT_CODES})")


def hot_codes(frequent, rows: int) -> list[str]:
    """The codes of the sketch with over a ``HOT_SHARE``-th of all rows."""
    return [item["item"] for item in frequent or [] if item["item"] is not None and item["count"] * HOT_SHARE > rows]


def join_descriptions(claims: DataFrame, icd_raw: DataFrame, hot: list[str] | None = None) -> DataFrame:
    """Strip both keys, LEFT join, fill the description.

    A row-level join (the fact keeps every row), so nothing can be aggregated
    first, and every missing code is one key ('UNKNOWN'). The rows of ``hot``
    codes meet the few list entries of those codes, which are broadcast, and stay
    where they are; all others are joined as the planner sees fit. ``claims`` is then
    read twice and should be a written table. Entries of hot codes beyond
    ``HOT_ENTRIES`` (a list that repeats a code) go the other way, too, and AQE splits them."""
    left = claims.withColumn("diagnosis_code", strip_ws("diagnosis_code"))
    codes = icd_descriptions(icd_raw)
    if hot:
        is_hot = F.coalesce(F.col("diagnosis_code").isin(hot), F.lit(False))
        few = codes.where(F.col("diagnosis_code").isin(hot))
        if few.limit(HOT_ENTRIES + 1).count() <= HOT_ENTRIES:
            spread = left.where(is_hot).join(F.broadcast(few), "diagnosis_code", "left")
            joined = left.where(~is_hot).join(codes, "diagnosis_code", "left").unionByName(spread)
        else:
            joined = left.join(codes, "diagnosis_code", "left")
    else:
        joined = left.join(codes, "diagnosis_code", "left")
    return joined.withColumn("description", F.coalesce(F.col("description"), F.lit(UNKNOWN_DIAGNOSIS_TEXT)))


def clean_claims(claims_raw: DataFrame, states: DataFrame) -> DataFrame:
    """Steps 1-5: the cleaned, de-duplicated claim rows.

    Which row of a claim is kept depends on its ids and file order alone, so the rows
    without an id go first and only those that are kept are named and coerced. A state
    code listed twice has one name here, as it had when the names came first."""
    df = select_and_rename(claims_raw).dropna(subset=IDS)
    df = keep_first(df, ["claim_id"], [c for c in (INGEST_ORDER,) if c in df.columns])
    return clean_values(map_state_names(df, states.dropDuplicates(["state_code"])))


def split_dims(claims: DataFrame, icd_raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three dims from the claims before the code join, whose copies
    of a row change none of them (first row per key in file order). A code's
    description is that of its first entry in the list."""
    own = [c for c in (INGEST_ORDER,) if c in claims.columns]
    dim_patient = (keep_first(claims.select("patient_id", "provider_state", "discharge_status",
                                            "admission_type", *own), ["patient_id"], own)
                   .withColumnRenamed("provider_state", "state")
                   .select(*DIM_PATIENT.fieldNames()))
    dim_provider = keep_first(claims.select("provider_id", "provider_state", "npi_number", *own),
                              ["provider_id"], own).select(*DIM_PROVIDER.fieldNames())
    codes = icd_descriptions(icd_raw)
    listed = keep_first(codes, ["diagnosis_code"], [c for c in (ICD_INGEST_ORDER,) if c in codes.columns] or ["description"])
    used = claims.select(strip_ws("diagnosis_code").alias("diagnosis_code")).distinct()
    dim_diagnosis = used.join(listed, "diagnosis_code", "left").withColumn(
        "description", F.coalesce(F.col("description"), F.lit(UNKNOWN_DIAGNOSIS_TEXT))).select(*DIM_DIAGNOSIS.fieldNames())
    return dim_patient, dim_provider, dim_diagnosis


def fact_with_order(rows: DataFrame) -> DataFrame:
    """The fact columns plus one file-order key (claim order, then code-list
    order), so the duplicate check can tell which fan-out copy is first."""
    order = [c for c in (INGEST_ORDER, ICD_INGEST_ORDER) if c in rows.columns]
    return rows.select(*FACT_CLAIMS.fieldNames(), F.struct(*order).alias(INGEST_ORDER))


def build_star(claims_raw: DataFrame, icd_raw: DataFrame, states: DataFrame):
    """The whole legacy ETL: returns (fact_claims, dim_patient, dim_provider, dim_diagnosis)."""
    claims = clean_claims(claims_raw, states)
    fact = join_descriptions(claims, icd_raw).select(*FACT_CLAIMS.fieldNames())
    return fact, *split_dims(claims, icd_raw)
