"""Spark side of the contract: one callable (spark, sf_dir) -> DataFrame per name.

Every query reads the test tables (through the fixture adapters) in full.
Queries that exercise a sink write to a fresh folder under the session's
checkpoint directory and return the lazily read-back result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.contracts import normalize as N
from carelake.functions.columns import strip_ws
from carelake.operators import (dedup, freshness, marts, quality, questions, sql_audit, staging,
                                star)
from carelake.plans.legacy_star import build_star_tables, run_star
from carelake.plans.medallion import MARTS, build_from_bronze, build_models, land, land_bronze, run_medallion
from carelake.schemas import RAW_CLAIM_COLUMNS
from carelake.session import apply_conf, scratch_path
from carelake.sources import claims_csv, fixtures, icd_csv, publish, seeds, sinks

FRESHNESS_NOW = "2001-11-05 12:00:00"


# ---------------------------------------------------------------- inputs

def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_claims(fixtures.claims_raw(spark, sf))


def _icd(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_icd_codes(fixtures.icd_codes_raw(spark, sf))


def _int_claims(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.int_claims_deduplicated(_stg(spark, sf))


def _summary(spark, sf):
    return marts.claims_summary(_int_claims(spark, sf), _icd(spark, sf), seeds.state_codes(spark))


def _providers(spark, sf):
    return marts.provider_performance(_int_claims(spark, sf), seeds.state_codes(spark))


def _diagnoses(spark, sf):
    return marts.diagnosis_cost_analysis(_int_claims(spark, sf), _icd(spark, sf))


def _norm_summary(mart):
    mart = N.money(mart, "total_paid", "total_charged", "total_denied_amount")
    return N.mean(mart, "avg_paid_per_claim", "total_claims")


def _norm_providers(mart):
    mart = N.money(mart, "total_paid", "total_charged")
    return N.mean(mart, "avg_claim_paid", "total_claims")


def _norm_diagnoses(mart):
    mart = N.money(mart, "total_cost", "cost_stddev")
    return N.mean(mart, "avg_cost_per_claim", "claim_count")


def _star(spark, sf):
    return star.build_star(fixtures.claims_raw(spark, sf), fixtures.icd_codes_raw(spark, sf),
                           seeds.state_codes(spark))


# ------------------------------------------------------ staging and marts

def q_stg_claims(spark, sf):
    """P1-P3."""
    return staging.drop_hidden(_stg(spark, sf))


def q_stg_icd_codes(spark, sf):
    """P4, P5."""
    return staging.drop_hidden(_icd(spark, sf))


def q_int_claims_deduplicated(spark, sf):
    """W1, P6, P7."""
    return staging.drop_hidden(_int_claims(spark, sf))


def q_mart_claims_summary(spark, sf):
    """A1, A4-A7, A11, J1, J2."""
    return _norm_summary(_summary(spark, sf))


def q_mart_provider_performance(spark, sf):
    """A2, A8, A10, J2."""
    return _norm_providers(_providers(spark, sf))


def q_mart_diagnosis_cost_analysis(spark, sf):
    """A3, A8, A9, J1."""
    return _norm_diagnoses(_diagnoses(spark, sf))


def q_mart_diagnosis_ranked(spark, sf):
    """The diagnosis mart in presentation order (highest total cost first), as ranks."""
    ranked = marts.ranked_by_cost(_norm_diagnoses(_diagnoses(spark, sf)))
    return ranked.select("rank", "diagnosis_code", "diagnosis_description", "total_cost")


# ------------------------------------------------------------ star schema

def q_star_fact_claims(spark, sf):
    """P8-P15, J3, J4, W2."""
    return _star(spark, sf)[0]


def q_star_dim_patient(spark, sf):
    """P16, W3."""
    return _star(spark, sf)[1]


def q_star_dim_provider(spark, sf):
    """P16, W4."""
    return _star(spark, sf)[2]


def q_star_dim_diagnosis(spark, sf):
    """P16, W5."""
    return _star(spark, sf)[3]


# ---------------------------------------------------------- quality gate

def _qc(check):
    def run(spark, sf):
        fact = fixtures.fact_dirty(spark, sf)
        return quality.failed_rows(fact, check).select(*quality.output_columns(fact))
    run.__doc__ = f"Q{quality.CHECK_BY_NAME[check].check_id}: failing rows of {check}."
    return run


def q_qc_report(spark, sf):
    """Q7: one row per check."""
    return quality.quality_report(fixtures.fact_dirty(spark, sf))


def q_qc_summary(spark, sf):
    """Q7, Q9: passed / total, pass rate, verdict."""
    return quality.quality_summary(quality.quality_report(fixtures.fact_dirty(spark, sf)))


def q_qc_quarantine(spark, sf):
    """Quarantine the failing rows of every check and read them back."""
    fact = fixtures.fact_dirty(spark, sf)
    paths = quality.quarantine(fact, scratch_path(spark, "quarantine"), compression="gzip")
    return quality.read_quarantine(spark, paths, fact.select(*quality.output_columns(fact)).schema)


# ----------------------------------------------------- tests, freshness

def _fixture_models(spark, sf, database: str | None = None):
    """R1 over the fixture's raw claims, in a run below a scratch folder."""
    return build_models(spark, fixtures.claims_raw(spark, sf), fixtures.icd_codes_raw(spark, sf),
                        seeds.state_codes(spark), scratch_path(spark, "models"), strict=False, database=database)


def q_model_tests(spark, sf):
    """D1-D6 over the staging, dedup and mart models (R1's test step)."""
    return _fixture_models(spark, sf).test_report


def q_icd_duplicate_codes(spark, sf):
    """ICD fan-out report: staged codes listed more than once."""
    from carelake.operators import model_tests
    return model_tests.duplicate_values(_icd(spark, sf), "diagnosis_code")


def q_source_freshness(spark, sf):
    """S12 with a fixed 'now'."""
    return freshness.source_freshness(fixtures.claims_raw(spark, sf, ingest_order=False),
                                      "claims_raw", "CLM_FROM_DT", FRESHNESS_NOW).drop("unparsed_rows")


def q_source_freshness_forms(spark, sf):
    """S12 over raw claims whose dates come in all three forms, some in none."""
    raw = fixtures.claims_raw(spark, sf, ingest_order=False).select("CLM_ID", "CLM_LINE_NUM", "CLM_FROM_DT")
    return freshness.source_freshness(raw.select(fixtures.mixed_dates().alias("loaded_at")), "claims_raw", "loaded_at", FRESHNESS_NOW)


# ------------------------------------------------------ KPIs, questions

def q_kpi_totals(spark, sf):
    """A12."""
    k = questions.kpi_totals(_int_claims(spark, sf))
    return N.mean(N.money(k, "total_spend"), "avg_cost_per_claim", "unique_claims")


def q_kpi_top_state(spark, sf):
    """A13."""
    return questions.kpi_top_state(_int_claims(spark, sf), seeds.state_codes(spark))


def q_kpi_yearly_cost(spark, sf):
    """A14."""
    return N.money(questions.kpi_yearly_cost(_int_claims(spark, sf)), "total_paid")


def q_row_counts(spark, sf):
    """Rows of every step of both runs, as the runs' own writes counted them. The
    raw claims are written once, as the bronze table, which stands for the star run's file."""
    codes, states = fixtures.icd_codes_raw(spark, sf), seeds.state_codes(spark)
    bronze = land_bronze(spark, fixtures.claims_raw(spark, sf), codes, states, scratch_path(spark, "models"))
    runs = sinks.run_concurrently({
        "models": lambda: build_from_bronze(spark, bronze, strict=False),
        "star": lambda: build_star_tables(spark, bronze.claims, codes, states, scratch_path(spark, "star"))})
    return runs["models"].row_counts.unionByName(runs["star"].row_counts)


def q_top_state_paid(spark, sf):
    """T2."""
    return N.money(questions.top_state_paid(_norm_summary(_summary(spark, sf))), "total_paid")


def q_top5_diagnosis_avg_cost(spark, sf):
    """T3."""
    return questions.top_diagnoses_by_avg_cost(_norm_diagnoses(_diagnoses(spark, sf)), 5)


def q_lowest_payment_ratio(spark, sf):
    """T4."""
    return questions.lowest_payment_ratio(_providers(spark, sf))


def q_summary_top5(spark, sf):
    """T5."""
    return questions.summary_top_paid(_norm_summary(_summary(spark, sf)), 5)


def q_providers_top100(spark, sf):
    """T6, T7 (the default cap of 100 rows)."""
    return questions.providers_top_paid(_norm_providers(_providers(spark, sf)), sql_audit.DEFAULT_ROW_LIMIT)


ADHOC_SQL = ("SELECT state, ROUND(SUM(total_paid), 4) AS total_paid, SUM(total_claims) AS total_claims "
             "FROM mart_claims_summary GROUP BY state")


def q_adhoc_state_totals(spark, sf):
    """S14 with G1-G5: an ad-hoc SQL text over the summary mart of a run, checked by
    the guardrails (which add LIMIT 100) and run by spark.sql in the run's schema.
    At most 54 state rows, so the limit cuts nothing."""
    run = publish.start_run(spark, scratch_path(spark, "adhoc"))
    publish.save(_summary(spark, sf), run, "mart_claims_summary")
    return sql_audit.run_query(spark, ADHOC_SQL, database=run.schema)


def q_mart_preview(spark, sf):
    """Five rows of the summary mart; which ones is unspecified, so the
    result is how many came and how many of them are rows of the mart."""
    mart = _norm_summary(_summary(spark, sf))
    keys = mart.columns[:5]
    shown = questions.preview(mart, 5).select(*[F.col(c).alias(f"p_{c}") for c in keys])
    same = None
    for c in keys:
        one = F.col(f"p_{c}").eqNullSafe(mart[c])
        same = one if same is None else same & one
    found = shown.join(mart.select(*keys).distinct(), same, "left_semi")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(shown, "rows_shown").withColumn("k", F.lit(1)).join(count(found, "rows_found").withColumn("k", F.lit(1)), "k").drop("k")


# --------------------------------------------------------- sources, sinks

def _write_claims_csv(spark, sf, kept=None) -> str:
    """The wide raw claims text, in several part files (lz4) that follow each other
    in the synthetic file order."""
    wide = fixtures.claims_file_wide(spark, sf)
    return sinks.write_claims_csv(wide if kept is None else wide.where(kept), scratch_path(spark, "claims_csv"), "lz4")


def _write_icd_csv(spark, sf) -> str:
    path = scratch_path(spark, "icd_csv")
    six = fixtures.icd_source_six(spark, sf).withColumn("__k", F.col("sub_code").cast("bigint"))
    return sinks.write_icd_source_csv(six.orderBy("__k").drop("__k"), path)


def q_csv_roundtrip_claims(spark, sf):
    """Write the raw claims as '|' text with extra columns before and
    between the used ones, read back by header name."""
    back = claims_csv.read_claims_csv(spark, _write_claims_csv(spark, sf), columns=RAW_CLAIM_COLUMNS, ingest_order=False)
    return back.withColumns({c: F.col(c).cast("double") for c in ("CLM_PMT_AMT", "CLM_TOT_CHRG_AMT")})


def q_bronze_claims(spark, sf):
    """Every column of the text file lands in bronze as it is."""
    raw = claims_csv.read_claims_csv(spark, _write_claims_csv(spark, sf), ingest_order=False)
    bronze = spark.read.parquet(sinks.write_table(raw, scratch_path(spark, "bronze")))
    # Numbers as text differ in form between engines; compare their values.
    return bronze.withColumns({c: F.col(c).cast("double") for c in (
        "CLM_PMT_AMT", "CLM_TOT_CHRG_AMT", "NCH_NEAR_LINE_REC_IDENT_CD", "NCH_PRMRY_PYR_CLM_PD_AMT", "CLM_UTLZTN_DAY_CNT")})


def q_star_from_files(spark, sf):
    """W2-W5 from text files: the first row by file order, dimensions in one list."""
    raw = claims_csv.read_claims_csv(spark, _write_claims_csv(spark, sf), columns=list(star.V1_RENAMES))
    icd = icd_csv.read_icd_csv(spark, _write_icd_csv(spark, sf), ingest_order=True)
    run = publish.start_run(spark, scratch_path(spark, "star_files"))
    raw, _ = land(spark, run, "claims_text", raw, claims_csv.INGEST_ORDER, {})
    icd, _ = land(spark, run, "codes_text", icd, icd_csv.ICD_INGEST_ORDER, {})
    fact, patients, providers, diagnoses = star.build_star(raw, icd, seeds.state_codes(spark))
    rows = lambda df, name: df.select(F.lit(name).alias("dimension"), F.col(df.columns[0]).alias("key"),
                                      F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in df.columns[1:]]).alias("value"))
    return rows(patients, "patient").union(rows(providers, "provider")).union(rows(diagnoses, "diagnosis"))


def q_csv_roundtrip_icd(spark, sf):
    """Six-column headerless file -> (code, description, category)
    -> canonical headered file -> read back."""
    icd = icd_csv.read_icd_csv(spark, _write_icd_csv(spark, sf))
    canonical = scratch_path(spark, "icd_canonical")
    icd_csv.write_icd_csv(icd, canonical)
    return icd_csv.read_icd_canonical(spark, canonical)


def q_sql_audit(spark, sf):
    """G1-G7 over a query log derived from orders."""
    return sql_audit.audit_sql(fixtures.sql_log(spark, sf))


def q_medallion_marts(spark, sf):
    """R1 (S1-S8, S13, W1, A1-A3, D1-D6): the full run from text files,
    summary mart read back from its written table."""
    out = scratch_path(spark, "medallion")
    run_medallion(spark, _write_claims_csv(spark, sf), _write_icd_csv(spark, sf), out, strict=False)
    return _norm_summary(publish.read_published(spark, out, "mart_claims_summary"))


def q_legacy_star_run(spark, sf):
    """R2 (S10, Q1-Q9): the legacy run from text files; its written quality
    report, with whether the star was loaded."""
    out = scratch_path(spark, "star")
    res = run_star(spark, _write_claims_csv(spark, sf), _write_icd_csv(spark, sf), out)
    return res.report.select("check_id", "check_name", "failed_rows", "status",
                             F.lit("loaded" if res.loaded else "not loaded").alias("load_status"))


def q_legacy_star_loaded(spark, sf):
    """The legacy run from text files whose claims pass the gate (no
    negative payment, one list entry per code): the four declared tables read back."""
    amount = F.col("CLM_PMT_AMT").cast("double")
    order = fixtures.icd_codes_raw(spark, sf).where("code is not null").withColumn("listed", strip_ws("code"))
    first = dedup.keep_first(order, ["listed"], [icd_csv.ICD_INGEST_ORDER]).select(F.col(icd_csv.ICD_INGEST_ORDER).alias("__k"))
    six = fixtures.icd_source_six(spark, sf).withColumn("__k", F.col("sub_code").cast("bigint")).join(first, "__k", "left_semi")
    codes = sinks.write_icd_source_csv(six.orderBy("__k").drop("__k"), scratch_path(spark, "icd_csv"))
    claims = _write_claims_csv(spark, sf, amount.isNull() | (amount >= 0))
    database = f"star_{uuid.uuid4().hex}"
    if not run_star(spark, claims, codes, scratch_path(spark, "star_loaded"), database).loaded:
        raise RuntimeError("the gate did not pass")
    parts = None
    for name in sinks.STAR_LOAD_ORDER:
        t = spark.table(f"{database}.{name}")
        part = t.select(F.lit(name).alias("table_name"), F.col(t.columns[0]).alias("key"), F.concat_ws("|", *[
            F.coalesce(F.round(F.col(c) * 100).cast("bigint").cast("string") if kind == "double" else F.col(c), F.lit("-"))
            for c, kind in t.dtypes[1:]]).alias("value"))
        parts = part if parts is None else parts.union(part)
    return parts


def q_run_views(spark, sf):
    """Rows of what a run from text files holds in its schema, its views among
    them, and of the marts' published tables."""
    database = f"marts_{uuid.uuid4().hex}"
    res = run_medallion(spark, _write_claims_csv(spark, sf), _write_icd_csv(spark, sf), scratch_path(spark, "views"), strict=False, database=database)
    views = ["stg_claims", "stg_icd_codes", "int_claims_deduplicated", *MARTS]
    return questions.row_counts({f"view {n}": spark.table(res.run.table(n)) for n in views}
                                | {f"table {n}": spark.table(f"{database}.{n}") for n in MARTS})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_claims": q_stg_claims,
    "stg_icd_codes": q_stg_icd_codes,
    "int_claims_deduplicated": q_int_claims_deduplicated,
    "mart_claims_summary": q_mart_claims_summary,
    "mart_provider_performance": q_mart_provider_performance,
    "mart_diagnosis_cost_analysis": q_mart_diagnosis_cost_analysis,
    "mart_diagnosis_ranked": q_mart_diagnosis_ranked,
    "star_fact_claims": q_star_fact_claims,
    "star_dim_patient": q_star_dim_patient,
    "star_dim_provider": q_star_dim_provider,
    "star_dim_diagnosis": q_star_dim_diagnosis,
    **{f"qc_{c.name}": _qc(c.name) for c in quality.CHECKS},
    "qc_report": q_qc_report,
    "qc_summary": q_qc_summary,
    "qc_quarantine": q_qc_quarantine,
    "model_tests": q_model_tests,
    "icd_duplicate_codes": q_icd_duplicate_codes,
    "source_freshness": q_source_freshness,
    "source_freshness_forms": q_source_freshness_forms,
    "kpi_totals": q_kpi_totals,
    "kpi_top_state": q_kpi_top_state,
    "kpi_yearly_cost": q_kpi_yearly_cost,
    "row_counts": q_row_counts,
    "q_top_state_paid": q_top_state_paid,
    "q_top5_diagnosis_avg_cost": q_top5_diagnosis_avg_cost,
    "q_lowest_payment_ratio": q_lowest_payment_ratio,
    "q_summary_top5": q_summary_top5,
    "q_providers_top100": q_providers_top100,
    "mart_preview": q_mart_preview,
    "adhoc_state_totals": q_adhoc_state_totals,
    "csv_roundtrip_claims": q_csv_roundtrip_claims,
    "csv_roundtrip_icd": q_csv_roundtrip_icd,
    "bronze_claims": q_bronze_claims,
    "star_from_files": q_star_from_files,
    "sql_audit": q_sql_audit,
    "medallion_marts": q_medallion_marts,
    "legacy_star_run": q_legacy_star_run,
    "legacy_star_loaded": q_legacy_star_loaded,
    "run_views": q_run_views,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {name: wrap(fn) for name, fn in QUERIES.items()}
