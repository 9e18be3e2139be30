"""Q1-Q9: the six-rule quality gate over fact_claims, with quarantine.

* The report is ONE aggregation pass over the fact table (conditional
  counts), not six scans; the duplicate count comes from the same pass as
  ``count(*) - (count(DISTINCT claim_id) + [any NULL claim_id])``.
* Failing rows are plain filters, except the duplicate rule: "every row but
  the first of its claim_id" is computed skew-safe -- the first row of each
  claim is found by an aggregation (partially aggregated before the
  shuffle, so a claim_id with a third of all rows costs one row per map
  partition), and the failing rows are an anti join against those firsts.
  No claim's rows are ever gathered into one task.
* The quarantine tags each row with the checks it fails and writes them by check,
  in one job over one scan (``failed_checks``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.sources.claims_csv import INGEST_ORDER


@dataclass(frozen=True)
class Check:
    check_id: int
    name: str
    description: str


# The six checks in run order; the names are the quarantine
# folder suffixes. The descriptions say what a failing row looks like.
CHECKS = [
    Check(1, "null_claim_id", "claim id missing"),
    Check(2, "null_patient_id", "patient id missing"),
    Check(3, "duplicate_claim_id", "claim id already seen earlier in the file"),
    Check(4, "negative_claim_amount", "paid amount below zero"),
    Check(5, "null_diagnosis_code", "diagnosis code missing"),
    Check(6, "empty_claim_date", "claim from-date missing, 'nan' or empty"),
]
CHECK_BY_NAME = {c.name: c for c in CHECKS}


def _row_predicates() -> dict[str, Column]:
    """Failing-row predicates of the five row-local rules."""
    d = F.col("claim_from_date")
    return {
        "null_claim_id": F.col("claim_id").isNull(),
        "null_patient_id": F.col("patient_id").isNull(),
        "negative_claim_amount": F.coalesce(F.col("claim_amount") < 0, F.lit(False)),
        "null_diagnosis_code": F.col("diagnosis_code").isNull(),
        "empty_claim_date": d.isNull() | d.isin("nan", ""),
    }


def duplicate_rows(fact: DataFrame, key: str = "claim_id", seq: str = INGEST_ORDER) -> DataFrame:
    """Q3: rows whose ``key`` already occurred earlier in file order (NULL
    keys count as equal). Needs the file-order column ``seq``.

    The first row of every key comes from an aggregation (partial before the
    shuffle, so a hot key costs one row per map partition); the rest is an anti
    join on (key, file order), so the rows of a hot key spread over every
    partition, and a small side is broadcast by AQE. Nothing runs while the plan
    is built. A row without file order comes after all rows with one; of a key
    whose rows all lack it, none can be told to be later, and none is returned.
    """
    firsts = fact.groupBy(F.col(key).alias("__key")).agg(F.min(seq).alias("__first"))
    cond = fact[key].eqNullSafe(F.col("__key")) & fact[seq].eqNullSafe(F.col("__first"))
    return fact.join(firsts, cond, "left_anti")


def failed_rows(fact: DataFrame, check: str) -> DataFrame:
    """The failing rows of one check (all input columns)."""
    if check == "duplicate_claim_id":
        return duplicate_rows(fact)
    return fact.where(_row_predicates()[check])


def output_columns(fact: DataFrame) -> list[str]:
    return [c for c in fact.columns if not c.startswith("_")]


def check_counts(fact: DataFrame) -> DataFrame:
    """Q7's single pass: one row with the failing count of every check and
    the number of records checked."""
    preds = _row_predicates()
    distinct_ids = F.count_distinct("claim_id") + F.max(F.col("claim_id").isNull().cast("int"))
    aggs = [F.count(F.lit(1)).alias("records_checked")]
    for c in CHECKS:
        if c.name == "duplicate_claim_id":
            aggs.append((F.count(F.lit(1)) - F.coalesce(distinct_ids, F.lit(0))).alias(c.name))
        else:
            aggs.append(F.count_if(preds[c.name]).alias(c.name))
    return fact.agg(*aggs)


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quality_report(fact: DataFrame) -> DataFrame:
    """Q7: one row per check -- check_id, check_name, description,
    failed_rows, status ('PASSED' / 'FAILED') -- and the records checked."""
    counts = check_counts(fact)
    stack = ", ".join(f"{c.check_id}L, '{c.name}', {_sql_str(c.description)}, `{c.name}`" for c in CHECKS)
    long = counts.selectExpr(
        "records_checked",
        f"stack({len(CHECKS)}, {stack}) as (check_id, check_name, description, failed_rows)")
    return long.select(
        "check_id", "check_name", "description",
        F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.when(F.col("failed_rows") == 0, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("status"),
        F.col("records_checked").cast("bigint").alias("records_checked"),
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """Q7, Q9: checks passed / total, records checked, pass rate in whole
    percent (half to even, like Python's round) and the load verdict."""
    passed = F.count_if(F.col("status") == "PASSED")
    total = F.count(F.lit(1))
    return report.agg(
        passed.cast("bigint").alias("checks_passed"),
        total.cast("bigint").alias("checks_total"),
        F.max("records_checked").alias("records_checked"),
        F.bround(passed * 100.0 / total, 0).cast("bigint").alias("pass_rate_pct"),
        F.when(passed == total, F.lit("safe to load")).otherwise(F.lit("review quarantine")).alias("verdict"),
    )


def all_passed(report: DataFrame) -> bool:
    """Q9 as a boolean (a six-row report is read back)."""
    return all(r["status"] == "PASSED" for r in report.select("status").collect())


def failed_checks(fact: DataFrame, seq: str = INGEST_ORDER) -> DataFrame:
    """Every row that fails a check, once for each it fails (``check_name``).

    ``fact`` is scanned once. Its rows are dealt out by (claim id, file order), so a
    hot claim spreads, and that one shuffle feeds both sides: the first row of each
    claim (partially aggregated where the rows lie) and the rows that are compared
    with it. Of rows with the same place in the file the one with the least hash
    is first; both sides so need the same columns, and Spark reuses the shuffle.
    Rows without a place are as in :func:`duplicate_rows`. Structs stand for the
    keys, as they are equal where both hold NULL; they are made where the rows arrive,
    so the shuffle carries no column twice."""
    columns = output_columns(fact)
    claim, place = F.struct("claim_id"), F.struct(F.col(seq).isNull().alias("lost"), F.col(seq).alias("at"))
    dealt = fact.select(*columns, seq).repartition(claim, place).select(
        *columns, claim.alias("__claim"), place.alias("__place"), F.xxhash64(*columns).alias("__hash"))
    firsts = dealt.groupBy(F.col("__claim").alias("__k")).agg(F.min(F.struct("__place", "__hash")).alias("__first")).select(
        "__k", F.col("__first.__place").alias("__first"), F.col("__first.__hash").alias("__first_hash"))
    same = (F.col("__claim") == F.col("__k")) & (F.col("__place") == F.col("__first")) & (
        F.col("__place.lost") | (F.col("__hash") == F.col("__first_hash")))
    told = dealt.join(firsts, same, "left")
    tests = _row_predicates() | {"duplicate_claim_id": F.col("__k").isNull()}
    names = F.array_compact(F.array(*[F.when(tests[c.name], F.lit(c.name)) for c in CHECKS]))
    return told.select(*columns, F.explode(names).alias("check_name"))


def quarantine(fact: DataFrame, root: str, report: DataFrame | None = None, compression: str = "none") -> dict[str, str]:
    """The failing rows of every check that has any (by the report, or
    without one by what is written), each as ``root/failed_<check>``, by one write
    over one scan of ``fact``, its text as it is or in a ``compression``. Returns check -> path; a clean table leaves nothing."""
    from carelake.sources.sinks import write_quarantine

    if report is None:
        return write_quarantine(failed_checks(fact), root, [c.name for c in CHECKS], True, compression)
    failed = {r["check_name"] for r in report.where("status = 'FAILED'").select("check_name").collect()}
    return write_quarantine(failed_checks(fact), root, [c.name for c in CHECKS if c.name in failed], False, compression) if failed else {}


def read_quarantine(spark, paths: dict[str, str], schema) -> DataFrame:
    """All quarantined rows (``schema``) with the check they failed as
    ``check_name``; no paths give an empty frame."""
    from carelake.sources.sinks import quarantine_reader

    out = spark.createDataFrame([], schema).withColumn("check_name", F.lit(""))
    for name, path in paths.items():
        out = out.unionByName(quarantine_reader(spark, schema).csv(path).withColumn("check_name", F.lit(name)))
    return out


def run_quality_checks(fact: DataFrame, dim_patient: DataFrame | None = None,
                       dim_provider: DataFrame | None = None, dim_diagnosis: DataFrame | None = None,
                       quarantine_root: str | None = None) -> DataFrame:
    """Q1-Q8: the report over ``fact``; with ``quarantine_root``, also write
    the failing rows of every failed check there (see :func:`quarantine`).

    The dimensions are accepted for interface parity; all six rules read
    only the fact table."""
    report = quality_report(fact)
    if quarantine_root is not None:
        quarantine(fact, quarantine_root, report)
    return report
