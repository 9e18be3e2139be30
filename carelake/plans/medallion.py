"""The medallion run -- raw files to bronze, silver and gold tables,
then the model tests.

    gate (S13) -> bronze (S1, S2, S5, S6) -> staging views (P1-P5, S7)
    -> de-duplicated claims (W1), written once -> marts (A1-A3, S8)
    -> model tests (D1-D6) and row counts (A15) -> publication

Every run has a catalog schema of its own (``publish.Run``) with its tables and its
staging views, so runs do not meet. Nothing is read only to be counted: each
write counts its own rows, and the columns its tests are about, as it goes by
(``publish.save``); what staging keeps is counted by the write of the bronze table it
reads. The de-duplicated claims are bucketed by claim id, as their shuffle left
them: the unique test and distinct counts read them without another. The written
tables cut the lineage: a lost executor during the mart stage recomputes from the
silver table rather than from the raw text.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import dedup, marts, model_tests, questions, staging
from carelake.session import apply_conf
from carelake.sources import claims_csv, icd_csv, ingest, publish, seeds
from carelake.sources.sinks import run_concurrently

MARTS = ("mart_claims_summary", "mart_provider_performance", "mart_diagnosis_cost_analysis")
VIEWS = ("stg_claims", "stg_icd_codes")
SILVER = "int_claims_deduplicated"


class ModelTestFailure(RuntimeError):
    """Raised when a declared model test finds failing rows."""


@dataclass
class MedallionResult:
    run: publish.Run | None = None
    tables: dict[str, str] = field(default_factory=dict)   # name -> path
    test_report: DataFrame | None = None
    row_counts: DataFrame | None = None
    failed_tests: list = field(default_factory=list)


def land(spark: SparkSession, run: publish.Run, name: str, raw: DataFrame, order: str, metrics: dict) -> tuple[DataFrame, dict]:
    """Write raw rows as they are; returns the table, with its file order as one
    number, and what the write counted."""
    counted = publish.save(raw, run, name, metrics)
    table = spark.table(run.table(name))
    if ingest.is_marked(table, order):
        publish.save(ingest.split_starts(table, order), run, f"{name}_splits")
        table = ingest.dense_order(table, order, spark.table(run.table(f"{name}_splits")))
    return table, counted


def _null_metrics(model: str, kept: str = "true") -> dict:
    """Failing rows of a model's not-null tests, for the write that the model goes through
    (few values are NULL, so that is tested first)."""
    return {f"null_{c}": F.count_if(F.expr(f"{_raw_value(model, c)} IS NULL") & F.expr(kept))
            for c, test in model_tests.MODEL_TESTS[model] if test == "not_null"}


def _raw_value(model: str, column: str) -> str:
    if model != "stg_claims":
        return column
    raw, kind = next((raw, kind) for raw, staged, kind in staging.RAW_TO_STAGED if staged == column)
    return f"TRY_CAST({raw} AS {kind.simpleString().upper()})"


@dataclass
class Bronze:
    """The landed layer of a run: its tables, and what their writes counted."""
    run: publish.Run
    claims: DataFrame
    codes: DataFrame
    states: DataFrame
    counts: dict[str, dict]


def land_bronze(spark: SparkSession, claims_raw: DataFrame, icd_raw: DataFrame, states: DataFrame, out_root: str) -> Bronze:
    """The bronze tables of a new run below ``out_root``, with the staging views on them."""
    apply_conf(spark)
    run = publish.start_run(spark, out_root)

    # On the way, what staging will keep of the rows.
    stg_metrics = {"stg_claims": F.count_if(F.expr(staging.CLAIMS_COUNTED))} | _null_metrics("stg_claims", staging.CLAIMS_COUNTED)
    landed = run_concurrently({
        "claims_raw": lambda: land(spark, run, "claims_raw", claims_raw, claims_csv.INGEST_ORDER, stg_metrics),
        "icd_codes_raw": lambda: land(spark, run, "icd_codes_raw", icd_raw, icd_csv.ICD_INGEST_ORDER,
                                      {"stg_icd_codes": F.count_if(F.expr(staging.CODES_KEPT))}),
        "state_codes": lambda: (None, publish.save(states, run, "state_codes"))})
    spark.sql(f"CREATE VIEW {run.table('stg_claims')} AS {staging.claims_view(run.table('claims_raw'))}")
    spark.sql(f"CREATE VIEW {run.table('stg_icd_codes')} AS {staging.codes_view(run.table('icd_codes_raw'))}")
    return Bronze(run, landed["claims_raw"][0], landed["icd_codes_raw"][0], spark.table(run.table("state_codes")),
                  {name: counted for name, (_, counted) in landed.items()})


def build_models(spark: SparkSession, claims_raw: DataFrame, icd_raw: DataFrame, states: DataFrame,
                 out_root: str, strict: bool = True, database: str | None = None) -> MedallionResult:
    """All layers from raw DataFrames, as a run below ``out_root``: the bronze
    tables, then :func:`build_from_bronze`."""
    return build_from_bronze(spark, land_bronze(spark, claims_raw, icd_raw, states, out_root), strict, database)


def build_from_bronze(spark: SparkSession, bronze: Bronze, strict: bool = True, database: str | None = None) -> MedallionResult:
    """The other layers of a run whose raw rows are landed; then the model
    tests and row counts. With ``strict`` a failing test raises after all
    tables are written (like a failed test step after the model step) and nothing
    is published; otherwise the run is published, with ``database`` as its tables."""
    run, claims, codes = bronze.run, bronze.claims, bronze.codes
    res = MedallionResult(run)
    buckets = (int(spark.conf.get("spark.sql.shuffle.partitions")), "claim_id")
    counts = dict(bronze.counts)

    silver = staging.drop_hidden(dedup.int_claims_deduplicated(staging.stg_claims(claims)))
    counts[SILVER] = publish.save(silver, run, SILVER, _null_metrics(SILVER), buckets)
    claims, icd, states = spark.table(run.table(SILVER)), staging.stg_icd_codes(codes), bronze.states
    jobs = {
        "mart_claims_summary": lambda: publish.save(marts.claims_summary(claims, icd, states), run, "mart_claims_summary", _null_metrics("mart_claims_summary")),
        "mart_provider_performance": lambda: publish.save(marts.provider_performance(claims, states), run, "mart_provider_performance", _null_metrics("mart_provider_performance")),
        "mart_diagnosis_cost_analysis": lambda: publish.save(marts.diagnosis_cost_analysis(claims, icd), run, "mart_diagnosis_cost_analysis", _null_metrics("mart_diagnosis_cost_analysis")),
        "unique": lambda: {"rows": model_tests.repeated_values(claims, "claim_id").first()[0]},
    }
    counts |= run_concurrently(jobs)

    failures = {("stg_claims", c, "not_null"): counts["claims_raw"][f"null_{c}"] for c, _ in model_tests.MODEL_TESTS["stg_claims"]}
    failures |= {(m, c, t): counts["unique"]["rows"] if t == "unique" else counts[m][f"null_{c}"]
                 for m in (SILVER, *MARTS) for c, t in model_tests.MODEL_TESTS[m]}
    steps = {"claims_raw": counts["claims_raw"]["rows"], "stg_claims": counts["claims_raw"]["stg_claims"],
             "stg_icd_codes": counts["icd_codes_raw"]["stg_icd_codes"], **{m: counts[m]["rows"] for m in (SILVER, *MARTS)}}
    run_concurrently({"model_tests": lambda: publish.save(model_tests.report_of(spark, failures), run, "model_tests"),
                      "row_counts": lambda: publish.save(questions.counted_rows(spark, steps), run, "row_counts")})

    written = ["claims_raw", "icd_codes_raw", "state_codes", SILVER, *MARTS, "model_tests", "row_counts"]
    res.tables = {n: run.path(n) for n in written}
    res.test_report, res.row_counts = spark.table(run.table("model_tests")), spark.table(run.table("row_counts"))
    res.failed_tests = [(*test, n) for test, n in failures.items() if n]
    if strict and res.failed_tests:
        raise ModelTestFailure(f"model tests failed: {res.failed_tests}")
    publish.publish(spark, run, written, database)
    return res


def run_medallion(spark: SparkSession, claims_path: str, icd_path: str, out_root: str,
                  states_path: str | None = None, strict: bool = True, database: str | None = None) -> MedallionResult:
    """The full run from the raw text files: gate, then :func:`build_models`."""
    apply_conf(spark)
    claims_csv.require_source(spark, claims_path)
    states = seeds.read_state_codes_csv(spark, states_path) if states_path else seeds.state_codes(spark)
    return build_models(spark, claims_csv.read_claims_csv(spark, claims_path), icd_csv.read_icd_csv(spark, icd_path, ingest_order=True),
                        states, out_root, strict, database)
