"""Sources and sinks (S1-S13), run plans (R1, R2) and plan shapes."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import questions
from carelake.sources import claims_csv, icd_csv, publish, seeds, sinks


def test_claims_csv_selects_by_name(spark, tmp_path):
    path = tmp_path / "claims.csv"
    cols = ["EXTRA0"] + claims_csv.RAW_CLAIM_COLUMNS[:5] + ["EXTRA1"] + claims_csv.RAW_CLAIM_COLUMNS[5:]
    vals = ["x", "C1", "B1", "P1", "01", "D001", "y", "470", "5.5", "10", "20150102", "02-Mar-2015",
            "10", "N", "01", "1"]
    path.write_text("|".join(cols) + "\n" + "|".join(vals) + "\n")
    assert set(claims_csv.read_claims_csv(spark, str(path), ingest_order=False).columns) == set(cols)
    df = claims_csv.read_claims_csv(spark, str(path), columns=claims_csv.RAW_CLAIM_COLUMNS, normalize_dates=True)
    r = df.collect()[0]
    assert r.CLM_ID == "C1" and r.CLM_LINE_NUM == "01" and r.CLM_DRG_CD == "470"
    assert r.CLM_FROM_DT == "2015-01-02" and r.CLM_THRU_DT == "2015-03-02"
    assert r._ingest_seq is not None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EXTRA0" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_missing_source_gate(spark, tmp_path):
    with pytest.raises(claims_csv.SourceMissing):
        claims_csv.require_source(spark, str(tmp_path / "nope.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text("CLM_ID|BENE_ID\n")
    with pytest.raises(claims_csv.SourceMissing):
        claims_csv.require_source(spark, str(empty))


def test_icd_csv_quoted_comma(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text('A00,0,A000,"Cholera, classical",long text,"Infectious, parasitic"\n')
    r = icd_csv.read_icd_csv(spark, str(path)).collect()[0]
    assert tuple(r) == ("A000", "Cholera, classical", "Infectious, parasitic")
    out = tmp_path / "canon"
    icd_csv.write_icd_csv(icd_csv.read_icd_csv(spark, str(path)), str(out))
    assert tuple(icd_csv.read_icd_canonical(spark, str(out)).collect()[0]) == tuple(r)


def test_seed(spark):
    s = seeds.state_codes(spark)
    assert s.count() == 53
    assert s.where("state_code = 10").first().state_name == "Florida"


def test_load_star_checks_keys(spark, tmp_path):
    fact = spark.createDataFrame([(None,)], "claim_id string").select(
        "claim_id", *[F.lit(None).cast(t).alias(c) for c, t in [
            ("patient_id", "string"), ("provider_id", "string"), ("diagnosis_code", "string"),
            ("claim_amount", "double"), ("total_charges", "double"), ("claim_from_date", "string"),
            ("claim_thru_date", "string"), ("drg_code", "string")]])
    with pytest.raises(sinks.NullKeyError):
        sinks.check_not_null({"fact_claims": fact})


def test_create_star_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS carelake_t")
    names = sinks.create_star_tables(spark, str(tmp_path), "carelake_t")
    assert len(names) == 4
    cols = [f.name for f in spark.table("carelake_t.fact_claims").schema.fields]
    assert cols[0] == "claim_id"


def test_topk_plans(spark, sf_small):
    from carelake.contracts.queries import _diagnoses
    plan = questions.top_diagnoses_by_avg_cost(_diagnoses(spark, sf_small))._jdf \
        .queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_medallion_and_star_runs(spark, sf_small):
    from carelake.contracts import queries as Q
    mart = Q.q_medallion_marts(spark, sf_small)
    assert mart.count() > 0
    rep = Q.q_legacy_star_run(spark, sf_small).collect()
    assert {r.load_status for r in rep} == {"not loaded"}
    # v1 keeps negative payments, and the ICD fan-out re-creates duplicate claim ids.
    assert {r.check_name for r in rep if r.status == "FAILED"} == {"duplicate_claim_id", "negative_claim_amount"}


def test_command_line_jobs(spark, sf_small, tmp_path):
    from carelake.__main__ import main
    from carelake.contracts import queries as Q
    from carelake.sources import fixtures
    claims, codes = Q._write_claims_csv(spark, sf_small), Q._write_icd_csv(spark, sf_small)
    # the fixture has NULL diagnosis codes (a D5 failure) and v1 duplicates: both exit 1
    assert main(["medallion", "--claims", claims, "--icd", codes, "--out", str(tmp_path / "m")]) == 1
    assert publish.read_published(spark, str(tmp_path / "m"), "mart_claims_summary").count() > 0
    assert main(["medallion", "--claims", claims, "--icd", codes, "--out", str(tmp_path / "m"), "--database", "cli_marts"]) == 1
    assert spark.table("cli_marts.mart_claims_summary").count() > 0
    assert main(["star", "--claims", claims, "--icd", codes, "--out", str(tmp_path / "s")]) == 1
    fixtures.sql_log(spark, sf_small).write.parquet(str(tmp_path / "log"))
    assert main(["audit", "--log", str(tmp_path / "log"), "--out", str(tmp_path / "a")]) == 0
    assert spark.read.parquet(str(tmp_path / "a")).count() == spark.read.parquet(str(tmp_path / "log")).count()


def test_star_loads_when_checks_pass(spark, tmp_path):
    from carelake.plans.legacy_star import build_star_tables
    from carelake.schemas import RAW_CLAIM_COLUMNS
    rows = [{"CLM_ID": f"C{i}", "BENE_ID": f"B{i % 3}", "PRVDR_NUM": f"P{i % 2}", "CLM_LINE_NUM": "1",
             "PRNCPAL_DGNS_CD": "D001", "CLM_DRG_CD": "470", "CLM_PMT_AMT": "10.5", "CLM_TOT_CHRG_AMT": "20",
             "CLM_FROM_DT": "2020-01-01", "CLM_THRU_DT": "2020-01-03", "PRVDR_STATE_CD": "10",
             "ORG_NPI_NUM": "N", "PTNT_DSCHRG_STUS_CD": "1", "CLM_IP_ADMSN_TYPE_CD": "1", "_ingest_seq": i}
            for i in range(6)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_CLAIM_COLUMNS) + ", _ingest_seq long")
    codes = spark.createDataFrame([("D001", "Desc", "cat", 1)], "code string, description string, "
                                                               "category string, _icd_seq long")
    res = build_star_tables(spark, raw, codes, seeds.state_codes(spark), str(tmp_path))
    assert res.loaded
    counts = {r.step: r.row_count for r in res.row_counts.collect()}
    assert counts == {"fact_claims": 6, "dim_patient": 3, "dim_provider": 2, "dim_diagnosis": 1}
    fact = spark.read.parquet(res.tables["fact_claims"])
    assert fact.columns == ["claim_id", "patient_id", "provider_id", "diagnosis_code", "claim_amount",
                            "total_charges", "claim_from_date", "claim_thru_date", "drg_code"]
    assert {r.provider_state for r in spark.read.parquet(res.tables["dim_provider"]).collect()} == {"Florida"}


def test_state_seed_csv(spark, tmp_path):
    p = tmp_path / "state_codes.csv"
    p.write_text("state_code,state_name\n" + "\n".join(f"{c},{n}" for c, n in seeds.STATE_CODES) + "\n")
    got = seeds.read_state_codes_csv(spark, str(p))
    assert got.schema.simpleString() == "struct<state_code:bigint,state_name:string>"
    assert sorted(map(tuple, got.collect())) == sorted(seeds.STATE_CODES)


def test_medallion_strict_raises_on_failed_tests(spark, sf_small, tmp_path):
    from carelake.contracts import queries as Q
    from carelake.plans.medallion import ModelTestFailure, run_medallion
    claims, codes = Q._write_claims_csv(spark, sf_small), Q._write_icd_csv(spark, sf_small)
    with pytest.raises(ModelTestFailure, match="mart_diagnosis_cost_analysis"):
        run_medallion(spark, claims, codes, str(tmp_path / "m"))
    # every layer was written before the test step failed, and none of it published
    assert not (tmp_path / "m/published").exists()
    (made,) = (tmp_path / "m/runs").iterdir()
    assert spark.read.parquet(str(made / "mart_provider_performance")).count() > 0


def test_seed_file_of_any_size(spark, tmp_path):
    p = tmp_path / "big_seed.csv"
    p.write_text("state_code,state_name\n" + "\n".join(f"{i},S{i}" for i in range(3000)) + "\n")
    assert seeds.read_state_codes_csv(spark, str(p)).count() == 3000


HEAD = "|".join(claims_csv.RAW_CLAIM_COLUMNS)


def test_claims_csv_quotes_and_backslashes(spark, tmp_path):
    rows = [['a "q" b', "back\\", "x|y", *"12345678901"], ["plain", "", "z", *"12345678901"]]
    df = spark.createDataFrame([tuple(r) for r in rows], [c for c in claims_csv.RAW_CLAIM_COLUMNS])
    back = claims_csv.read_claims_csv(spark, sinks.write_claims_csv(df, str(tmp_path / "c")), ingest_order=False)
    assert sorted(back.collect())[0][:3] == ('a "q" b', "back\\", "x|y")
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("*.csv")))
    assert '"a ""q"" b"' in text


@pytest.mark.parametrize("line", ["|".join("1" * 15), "|".join("1" * 13)])
def test_claims_csv_refuses_malformed_lines(spark, tmp_path, line):
    (tmp_path / "c.csv").write_text(f"{HEAD}\n{'|'.join('1' * 14)}\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE|FAILFAST"):
        claims_csv.read_claims_csv(spark, str(tmp_path / "c.csv")).collect()


def test_claims_csv_refuses_another_header(spark, tmp_path):
    names = claims_csv.RAW_CLAIM_COLUMNS
    (tmp_path / "d").mkdir()
    (tmp_path / "d/1.csv").write_text(f"{HEAD}\n{'|'.join('1' * 14)}\n")
    (tmp_path / "d/2.csv").write_text("|".join([names[1], names[0], *names[2:]]) + f"\n{'|'.join('2' * 14)}\n")
    with pytest.raises(Exception, match="header"):
        claims_csv.read_claims_csv(spark, str(tmp_path / "d")).collect()


def test_file_order_is_path_order(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for i in range(6):
        (tmp_path / f"d/part-{i}.csv").write_text(HEAD + "\n" + "|".join([str(i)] + ["1"] * 13) + "\n")
    df = claims_csv.read_claims_csv(spark, str(tmp_path / "d"))
    assert [r.CLM_ID for r in df.orderBy("_ingest_seq").collect()] == list("012345")


def test_scratch_needs_a_shared_folder_off_local_mode(monkeypatch):
    from carelake import session

    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(type("S", (), {"sparkContext": Context}))
