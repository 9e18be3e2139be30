"""Command line: run a job with the session spark-submit provides.

    spark-submit --py-files carelake.zip carelake/__main__.py medallion \
        --claims raw/claims.csv --icd raw/codes.csv --out /lake/claims
    python -m carelake star --claims raw/claims.csv --icd raw/codes.csv --out /lake/claims_v1
    python -m carelake audit --log /lake/query_log --out /lake/query_audit

``medallion`` exits non-zero when a model test fails, ``star`` when the
quality gate keeps the star from loading.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="carelake")
    sub = p.add_subparsers(dest="job", required=True)
    for job in ("medallion", "star"):
        s = sub.add_parser(job)
        s.add_argument("--claims", required=True, help="raw '|' claims file(s)")
        s.add_argument("--icd", required=True, help="six-column ICD-10 code list")
        s.add_argument("--out", required=True, help="output root folder")
        s.add_argument("--database", help="schema whose tables switch to this run when it is done")
        if job == "medallion":
            s.add_argument("--states", help="state_codes.csv seed (default: built in)")
    a = sub.add_parser("audit")
    a.add_argument("--log", required=True, help="parquet table with query_id, sql_text")
    a.add_argument("--out", required=True)
    a.add_argument("--project", default="analytics")
    a.add_argument("--dataset", default="marts")
    args = p.parse_args(argv)

    from carelake.session import apply_conf

    spark = apply_conf(SparkSession.builder.appName(f"carelake-{args.job}").getOrCreate())
    if args.job == "medallion":
        from carelake.plans.medallion import run_medallion
        res = run_medallion(spark, args.claims, args.icd, args.out, args.states, strict=False, database=args.database)
        res.test_report.show(truncate=False)
        return 1 if res.failed_tests else 0
    if args.job == "star":
        from carelake.plans.legacy_star import run_star
        res = run_star(spark, args.claims, args.icd, args.out, database=args.database)
        res.report.show(truncate=False)
        return 0 if res.loaded else 1
    from carelake.operators.sql_audit import audit_sql
    from carelake.sources.sinks import write_table
    log = spark.read.parquet(args.log)
    write_table(audit_sql(log, project=args.project, dataset=args.dataset), args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
