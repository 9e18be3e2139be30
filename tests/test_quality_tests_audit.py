"""Quality gate (Q1-Q9), model tests (D1-D6), freshness (S12), SQL audit."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import freshness, model_tests, quality, sql_audit

FACT = ("claim_id string, patient_id string, provider_id string, diagnosis_code string, "
        "claim_amount double, total_charges double, claim_from_date string, "
        "claim_thru_date string, drg_code string, _ingest_seq bigint")


def fact(spark, rows):
    full = []
    for i, r in enumerate(rows):
        d = dict(claim_id=f"C{i}", patient_id="B", provider_id="P", diagnosis_code="D",
                 claim_amount=1.0, total_charges=1.0, claim_from_date="2020-01-01",
                 claim_thru_date="2020-01-02", drg_code="1", _ingest_seq=i)
        d.update(r)
        full.append(d)
    return spark.createDataFrame(full, FACT)


def test_null_and_duplicate_ids(spark):
    f = fact(spark, [{"claim_id": None}, {"claim_id": None}, {"claim_id": "A"}, {"claim_id": "A"}])
    assert quality.failed_rows(f, "null_claim_id").count() == 2
    dup = quality.failed_rows(f, "duplicate_claim_id").collect()
    assert sorted(r._ingest_seq for r in dup) == [1, 3]
    counts = quality.check_counts(f).collect()[0]
    assert counts.duplicate_claim_id == 2 and counts.null_claim_id == 2


def test_empty_dates_and_negative(spark):
    f = fact(spark, [{"claim_from_date": None}, {"claim_from_date": "nan"},
                     {"claim_from_date": ""}, {"claim_from_date": "2020-01-01"},
                     {"claim_amount": -1.0}, {"claim_amount": float("nan")}, {"claim_amount": None}])
    assert quality.failed_rows(f, "empty_claim_date").count() == 3
    assert quality.failed_rows(f, "negative_claim_amount").count() == 1


def test_report_summary_and_quarantine(spark, tmp_path):
    f = fact(spark, [{}, {"claim_id": "C0"}])
    report = quality.run_quality_checks(f, quarantine_root=str(tmp_path))
    rows = {r.check_name: r for r in report.collect()}
    assert rows["duplicate_claim_id"].failed_rows == 1 and rows["duplicate_claim_id"].status == "FAILED"
    assert rows["null_claim_id"].status == "PASSED"
    assert (tmp_path / "failed_duplicate_claim_id").exists()
    assert not (tmp_path / "failed_null_claim_id").exists()
    back = quality.read_quarantine(spark, {"duplicate_claim_id": str(tmp_path / "failed_duplicate_claim_id")},
                                   f.select(*quality.output_columns(f)).schema)
    assert [r.check_name for r in back.collect()] == ["duplicate_claim_id"]
    s = quality.quality_summary(report).collect()[0]
    assert (s.checks_passed, s.checks_total, s.pass_rate_pct, s.verdict) == (5, 6, 83, "review quarantine")
    assert not quality.all_passed(report)


def test_model_tests_report(spark):
    stg = spark.createDataFrame([("A", "p"), ("A", None), (None, "q")], "claim_id string, patient_id string")
    rep = model_tests.run_model_tests(
        {"int_claims_deduplicated": stg, "stg_claims": stg},
        {"int_claims_deduplicated": [("claim_id", "unique"), ("claim_id", "not_null")],
         "stg_claims": [("patient_id", "not_null")]})
    got = {(r.model, r.column_name, r.test): (r.failures, r.status) for r in rep.collect()}
    assert got == {("int_claims_deduplicated", "claim_id", "unique"): (1, "fail"),
                   ("int_claims_deduplicated", "claim_id", "not_null"): (1, "fail"),
                   ("stg_claims", "patient_id", "not_null"): (1, "fail")}


def test_freshness(spark):
    df = spark.createDataFrame([("2001-11-04",), ("2001-11-01",)], "d string")
    r = freshness.source_freshness(df, "x", "d", "2001-11-05 12:00:00").collect()[0]
    assert r.age_hours == 36.0 and r.status == "warn" and r.max_loaded_at == "2001-11-04 00:00:00"
    r = freshness.source_freshness(df, "x", "d", "2001-11-04 12:00:00").collect()[0]
    assert r.status == "pass"
    r = freshness.source_freshness(df, "x", "d", "2001-11-09 12:00:00", error_after_hours=72).collect()[0]
    assert r.status == "error"


def test_freshness_reads_every_date_form(spark):
    now = "2015-03-10 12:00:00"
    cases = [(["07-Mar-2015"], "2015-03-07 00:00:00", 0), (["20150309"], "2015-03-09 00:00:00", 0), (["2015-03-09 11:30:00"], "2015-03-09 11:30:00", 0),
             (["2015-03-01", "08-mar-2015", "20150302", None], "2015-03-08 00:00:00", 0),
             (["2015-03-01", "2015-13-45", "99999999", "31-Xyz-2015", "", "soon"], "2015-03-01 00:00:00", 5), (["soon", None], None, 1), ([], None, 0)]
    for values, newest, unparsed in cases:
        r = freshness.source_freshness(spark.createDataFrame([(v,) for v in values], "d string"), "x", "d", now).first()
        assert (r.max_loaded_at, r.unparsed_rows) == (newest, unparsed), values
        assert r.status == ("error" if newest is None else "warn")


AUDIT_CASES = [
    ("SELECT state, total_paid FROM mart_claims_summary ORDER BY total_paid DESC LIMIT 5", "pass", None, None),
    ("DELETE FROM mart_claims_summary WHERE state = 'FL'", "blocked", "keyword", "DELETE"),
    ("SELECT * FROM mart_claims_summary; DROP TABLE mart_claims_summary;", "blocked", "keyword", "DROP"),
    ("SELECT * FROM stg_claims LIMIT 10", "blocked", "table", "stg_claims"),
    ("SELECT provider_id, total_paid FROM mart_provider_performance ORDER BY total_paid DESC", "pass", None, None),
    ("WITH x AS (SELECT * FROM mart_claims_summary) SELECT * FROM x", "blocked", "table", "x"),
    ("SELECT EXTRACT(YEAR FROM c) FROM mart_claims_summary", "blocked", "table", "c"),
    ("SELECT 1", "blocked", "no_table", None),
    ("EXPLAIN SELECT * FROM mart_claims_summary", "blocked", "not_select", None),
    ("SELECT * FROM Mart_Claims_Summary", "blocked", "table", "Mart_Claims_Summary"),
    ("SELECT * FROM ds.mart_claims_summary", "pass", None, None),
    ("SELECT * FROM my-proj.ds.mart_claims_summary", "blocked", "table", "my"),
]


def test_audit_rules(spark):
    log = spark.createDataFrame([(i, s) for i, (s, *_) in enumerate(AUDIT_CASES)], "query_id long, sql_text string")
    out = {r.query_id: r for r in sql_audit.audit_sql(log).collect()}
    for i, (_, verdict, rule, detail) in enumerate(AUDIT_CASES):
        assert (out[i].verdict, out[i].rule, out[i].detail) == (verdict, rule, detail), AUDIT_CASES[i][0]
    assert out[0].safe_sql == AUDIT_CASES[0][0]
    assert out[4].safe_sql == AUDIT_CASES[4][0] + "\nLIMIT 100"
    assert out[4].qualified_sql.startswith("SELECT provider_id, total_paid FROM `analytics.marts.mart_provider_performance`")


def test_audit_cleanup_and_limit_rewrite(spark):
    texts = ["```sql\nSELECT * FROM mart_claims_summary\n```",
             "SELECT * FROM mart_claims_summary ;  ",
             "SELECT * FROM (SELECT * FROM mart_claims_summary LIMIT 3) t"]
    log = spark.createDataFrame(list(enumerate(texts)), "query_id long, sql_text string")
    out = {r.query_id: r for r in sql_audit.audit_sql(log).collect()}
    assert out[0].sql == "SELECT * FROM mart_claims_summary" and out[0].verdict == "pass"
    assert out[1].safe_sql == "SELECT * FROM mart_claims_summary \nLIMIT 100"
    assert out[2].safe_sql == texts[2]


@pytest.mark.parametrize("bad", ["a.b", "x$y"])
def test_qualify_rejects_odd_names(bad):
    with pytest.raises(ValueError):
        sql_audit.qualify_tables(F.col("x"), bad, "ds")


def test_run_query_gates_and_limits(spark):
    spark.range(150).selectExpr("cast(id as string) as state", "id * 1.0 as total_paid") \
        .createOrReplaceTempView("mart_claims_summary")
    df = sql_audit.run_query(spark, "SELECT state, total_paid FROM mart_claims_summary ORDER BY total_paid DESC")
    assert df.count() == 100
    with pytest.raises(sql_audit.GuardrailViolation):
        sql_audit.run_query(spark, "DROP TABLE mart_claims_summary")


def test_quarantine_of_a_clean_table_is_empty_and_readable(spark, tmp_path):
    f = fact(spark, [{}])
    paths = quality.quarantine(f, str(tmp_path))
    assert paths == {}
    assert quality.read_quarantine(spark, paths, f.select(*quality.output_columns(f)).schema).count() == 0


def test_quarantine_tells_null_from_empty(spark, tmp_path):
    f = fact(spark, [{"claim_id": "A", "claim_from_date": None}, {"claim_id": "B", "claim_from_date": ""}])
    paths = quality.quarantine(f, str(tmp_path))
    back = quality.read_quarantine(spark, paths, f.select(*quality.output_columns(f)).schema)
    got = {r.claim_id: r.claim_from_date for r in back.where("check_name = 'empty_claim_date'").collect()}
    assert got == {"A": None, "B": ""}


def test_run_query_accepts_only_mart_plans(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) as state").createOrReplaceTempView("mart_claims_summary")
    spark.range(3).selectExpr("cast(id as string) as state").createOrReplaceTempView("stg_claims")
    spark.range(3).write.parquet(str(tmp_path / "t"))
    m = "SELECT a.state FROM mart_claims_summary a"
    for bad in ("SELECT state FROM mart_claims_summary UNION ALL SELECT state FROM\u00a0stg_claims",
                f"{m}, stg_claims b", f"{m}, parquet.`{tmp_path}/t` b", f"{m}, range(5) b",
                "SELECT reflect('java.lang.System', 'lineSeparator') FROM mart_claims_summary",
                "SELECT `java_method`('java.lang.System', 'lineSeparator') FROM mart_claims_summary",
                "SELECT upper(try_reflect('java.lang.System', 'lineSeparator')) FROM mart_claims_summary",
                f"{m} WHERE EXISTS (SELECT 1 FROM mart_claims_summary c, stg_claims d)"):
        with pytest.raises(sql_audit.GuardrailViolation):
            sql_audit.run_query(spark, bad)
    with pytest.raises(sql_audit.QueryExecutionError):
        sql_audit.run_query(spark, "SELECT no_such_column FROM mart_claims_summary")
    plain = "SELECT url_encode(state) AS s FROM mart_claims_summary LIMIT 1"
    assert sql_audit.run_query(spark, plain).count() == 1
    good = "SELECT state FROM mart_claims_summary WHERE state IN (SELECT max(state) FROM mart_claims_summary)"
    assert [r.state for r in sql_audit.run_query(spark, good).collect()] == ["2"]


def test_duplicates_build_without_a_job_and_define_missing_order(spark):
    f = fact(spark, [{"claim_id": "A"}, {"claim_id": "A"}])
    seen = []
    count = type(f).count
    type(f).count = lambda self: seen.append(1) or count(self)
    try:
        plan = quality.duplicate_rows(f)
    finally:
        type(f).count = count
    assert not seen and plan.count() == 1
    lost = f.withColumn("_ingest_seq", F.lit(None).cast(f.schema["_ingest_seq"].dataType))
    assert quality.duplicate_rows(lost).count() == 0
