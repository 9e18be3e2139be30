"""R2: the legacy star run -- extract, transform, quality gate, load.

    read claims + code list -> cleaned, one row a claim (P8-P13, J3, W2), and landed
    (the list as it is), where their file order is to become one number
    -> described (P14, P15, J4)
    -> dimensions (P16, W3-W5) and quality report + quarantine (Q1-Q8)
    -> the fact, and publication of the star (S9, S10), only when every check passed (Q9)
    -> row counts of every step (A15), as the writes counted them

A run writes into a schema of its own; the tables that are read change over at the
end, dimensions before the fact. A run that fails, in a check or in a write, leaves
the star before it whole.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from carelake.operators import quality, questions, star
from carelake.plans.medallion import land
from carelake.schemas import STAR_TABLES
from carelake.session import apply_conf
from carelake.sources import claims_csv, icd_csv, ingest, publish, seeds, sinks


@dataclass
class StarResult:
    run: publish.Run | None = None
    loaded: bool = False
    tables: dict[str, str] = field(default_factory=dict)   # name -> path
    report: DataFrame | None = None
    row_counts: DataFrame | None = None


def build_star_tables(spark: SparkSession, claims_raw: DataFrame, icd_raw: DataFrame,
                      states: DataFrame, out_root: str, database: str | None = None) -> StarResult:
    """The legacy ETL from raw DataFrames, as a run below ``out_root``; with
    ``database`` the star's tables are declared there (S9) and switched to the run."""
    apply_conf(spark)
    run = publish.start_run(spark, out_root)
    res = StarResult(run)
    read = lambda name: spark.table(run.table(name))
    claims_raw = claims_raw.select(*star.used_columns(claims_raw))

    # The cleaned claims are read by the code join and two dimensions; the write
    # finds the codes that many of them share, too. Marks sort in file order, so the text
    # is cleaned as it is read, and the fewer rows that are left get their numbers.
    jobs = {"claims": lambda: land(spark, run, "claims_clean", star.clean_claims(claims_raw, states), claims_csv.INGEST_ORDER,
                                   {"codes": star.frequent_codes()})}
    if ingest.is_marked(icd_raw, icd_csv.ICD_INGEST_ORDER):  # others have their number
        jobs["codes"] = lambda: land(spark, run, "codes_text", icd_raw, icd_csv.ICD_INGEST_ORDER, {})
    landed = sinks.run_concurrently(jobs)
    claims, cleaned = landed["claims"]
    icd_raw = landed["codes"][0] if "codes" in landed else icd_raw
    described = star.join_descriptions(claims, icd_raw, star.hot_codes(cleaned["codes"], cleaned["rows"]))
    dims = dict(zip(("dim_patient", "dim_provider", "dim_diagnosis"), star.split_dims(claims, icd_raw)))
    counts = sinks.run_concurrently({"fact_claims": lambda: publish.save(star.fact_with_order(described), run, "claims_v1")["rows"]} | {
        n: (lambda n=n, d=d: publish.save(sinks.required(d, n), run, n)["rows"]) for n, d in dims.items()})

    staged = read("claims_v1")
    publish.save(quality.run_quality_checks(staged, *(read(n) for n in dims)), run, "quality_report")
    res.report = read("quality_report")
    quality.quarantine(staged, f"{run.folder}/quarantine", res.report)
    res.tables = {n: run.path(n) for n in ("claims_v1", *dims, "quality_report", "row_counts")}
    if quality.all_passed(res.report):
        fact = staged.select(*STAR_TABLES["fact_claims"].fieldNames())
        counts["fact_claims"] = publish.save(sinks.required(fact, "fact_claims"), run, "fact_claims")["rows"]
        res.tables["fact_claims"] = run.path("fact_claims")
        publish.publish(spark, run, sinks.STAR_LOAD_ORDER, database, declared=STAR_TABLES)
        res.loaded = True
    publish.save(questions.counted_rows(spark, counts), run, "row_counts")
    res.row_counts = read("row_counts")
    return res


def run_star(spark: SparkSession, claims_path: str, icd_path: str, out_root: str, database: str | None = None) -> StarResult:
    """Run the legacy ETL from the raw text files."""
    raw = claims_csv.read_claims_csv(spark, claims_path, columns=list(star.V1_RENAMES))
    icd_raw = icd_csv.read_icd_csv(spark, icd_path, ingest_order=True)
    return build_star_tables(spark, raw, icd_raw, seeds.state_codes(spark), out_root, database)
