"""Runs and publication (S7-S10, S14), counts on writes (A15, D1-D6), bucketed
silver (D2, A12, W1), dense file order (W2-W5), ranks (T1)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from carelake.contracts import queries
from carelake.operators import marts, model_tests, questions, quality, ranking, sql_audit, star
from carelake.plans.legacy_star import build_star_tables, run_star
from carelake.plans.medallion import MARTS, SILVER, build_models, land_bronze
from carelake.schemas import RAW_CLAIM_COLUMNS, STAR_TABLES
from carelake.sources import fixtures, ingest, publish, seeds, sinks
from tests.test_plan_shapes import exchanges, plan_of
from tests.test_skew import forced_shuffle, skewed_raw


def raw_claims(spark, n, amount="10.5", code="D001"):
    rows = [(f"C{i}", f"B{i % 3}", f"P{i % 2}", "1", code, "470", amount, "20", "2020-01-01", "2020-01-03", "10", "N", "1", "1", i) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_CLAIM_COLUMNS) + ", _ingest_seq long")


def code_list(spark, *codes):
    return spark.createDataFrame([(c, f"about {c}", "cat", i) for i, c in enumerate(codes)] or [("X", "x", "x", 0)],
                                 "code string, description string, category string, _icd_seq long")


def models(spark, root, n=6, database=None, amount="10.5"):
    return build_models(spark, raw_claims(spark, n, amount), code_list(spark, "D001"), seeds.state_codes(spark), str(root), strict=False, database=database)


# ------------------------------------------------------------ counts on writes

def test_counts_of_the_writes_are_those_of_the_tables(spark, sf_small, tmp_path):
    """Without one relation scanned to be counted: the report equals counts of the tables."""
    res = build_models(spark, fixtures.claims_raw(spark, sf_small), fixtures.icd_codes_raw(spark, sf_small),
                       seeds.state_codes(spark), str(tmp_path), strict=False)
    got = {r.step: r.row_count for r in res.row_counts.collect()}
    assert got == {n: spark.table(res.run.table(n)).count() for n in ("claims_raw", "stg_claims", "stg_icd_codes", SILVER, *MARTS)}
    tables = {n: spark.table(res.run.table(n)) for n in ("stg_claims", SILVER, *MARTS)}
    want = model_tests.run_model_tests(tables)
    assert sorted(map(tuple, res.test_report.collect())) == sorted(map(tuple, want.select(res.test_report.columns).collect()))


def test_counts_of_empty_and_failing_inputs(spark, tmp_path):
    none = models(spark, tmp_path / "none", 0)
    assert {r.row_count for r in none.row_counts.where("step <> 'stg_icd_codes'").collect()} == {0}
    bad = models(spark, tmp_path / "bad", 4, amount="-1")   # staging keeps none
    got = {r.step: r.row_count for r in bad.row_counts.collect()}
    assert got["claims_raw"] == 4 and got["stg_claims"] == got[SILVER] == 0
    # a payment that is no number fails staging, not the bronze write
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        models(spark, tmp_path / "text", 2, amount="abc")


def test_row_counts_write_the_raw_claims_once(spark, sf_small, monkeypatch):
    """Both runs read the landed claims: no other copy of the wide raw rows is written."""
    wide, save = [], publish.save

    def copied(df, *_, **__):
        raise AssertionError("a copy beside the bronze table")

    def saved(df, run, name, *rest):
        wide.extend([name] if set(RAW_CLAIM_COLUMNS) <= set(df.columns) else [])
        return save(df, run, name, *rest)

    monkeypatch.setattr(sinks, "write_table", copied)
    monkeypatch.setattr(publish, "save", saved)
    got = {r.step: r.row_count for r in queries.q_row_counts(spark, sf_small).collect()}
    assert wide == ["claims_raw"] and got["claims_raw"] == fixtures.table(spark, sf_small, "lineitem").count()


def test_star_cleans_the_rows_it_keeps(spark):
    """One row of a claim is kept before any is named or coerced; copies of a raw row, and
    a state code listed twice, leave one row a claim."""
    raw = raw_claims(spark, 3).unionByName(raw_claims(spark, 3, amount="abc").withColumn("_ingest_seq", F.col("_ingest_seq") + 100))
    raw = raw.unionByName(raw).withColumn("BENE_ID", F.when(F.col("_ingest_seq") != 1, F.col("BENE_ID")))
    states = seeds.state_codes(spark)
    clean = star.clean_claims(raw, states.unionByName(states))
    got = [(r.claim_id, r.claim_amount, r.provider_state) for r in clean.orderBy("claim_id").collect()]
    assert got == [("C0", 10.5, "Florida"), ("C1", 0.0, "Florida"), ("C2", 10.5, "Florida")]
    below = plan_of(clean).split("Window [", 1)[1]
    assert "BroadcastHashJoin" not in below and "try_cast" not in below.lower()


def test_null_metrics_test_the_value_first(spark, tmp_path):
    """The null counts of staging are of kept rows, whatever else a row lacks."""
    raw = raw_claims(spark, 4).withColumns({"CLM_PMT_AMT": F.when(F.col("CLM_ID") != "C1", F.lit("10.5")),
                                            "BENE_ID": F.when(F.col("CLM_ID") != "C2", F.col("BENE_ID"))})
    bronze = land_bronze(spark, raw, code_list(spark, "D001"), seeds.state_codes(spark), str(tmp_path))
    assert bronze.counts["claims_raw"] == {"rows": 4, "stg_claims": 2, "null_claim_id": 0, "null_patient_id": 0,
                                           "null_provider_id": 0, "null_claim_amount": 0}
    assert bronze.claims.count() == 4 and bronze.codes.count() == 1 and bronze.states.count() == len(seeds.STATE_CODES)


def test_save_counts_every_row_once(spark, tmp_path):
    run = publish.start_run(spark, str(tmp_path))
    got = publish.save(spark.range(1000).repartition(7), run, "t", {"odd": F.count_if(F.col("id") % 2 == 1), "top": F.max("id")})
    assert got == {"rows": 1000, "odd": 500, "top": 999}


# ------------------------------------------------------------- bucketed silver

def test_silver_is_read_by_claim_without_a_shuffle(spark, tmp_path):
    res = models(spark, tmp_path)
    silver = spark.table(res.run.table(SILVER))
    for df in (model_tests.repeated_values(silver, "claim_id"), questions.kpi_totals(silver),
               model_tests.model_failures(silver, SILVER, model_tests.MODEL_TESTS[SILVER])):
        assert not [e for e in exchanges(plan_of(df)) if "claim_id" in e or "__value" in e], plan_of(df)
        assert "Bucketed: true" in plan_of(df)
    assert questions.kpi_totals(silver).first().unique_claims == 6


# ---------------------------------------------------------- publication, S9, S10

def test_published_marts_change_over(spark, tmp_path):
    first = models(spark, tmp_path, 3, "pub_marts")
    held = {r.step: r.row_count for r in first.row_counts.collect()}
    assert spark.table("pub_marts.int_claims_deduplicated").count() == held[SILVER] == 3
    second = models(spark, tmp_path, 5, "pub_marts")
    assert spark.table("pub_marts.int_claims_deduplicated").count() == 5
    assert publish.published(spark, str(tmp_path))[SILVER] == second.run.path(SILVER)
    assert spark.table(first.run.table(SILVER)).count() == 3      # the run before is still whole
    assert "Bucketed: true" in plan_of(questions.kpi_totals(spark.table("pub_marts.int_claims_deduplicated")))
    publish.drop_run(spark, first.run)
    assert not spark.catalog.databaseExists(first.run.schema)
    with pytest.raises(ValueError, match="published"):
        publish.drop_run(spark, second.run)
    assert publish.read_published(spark, str(tmp_path), SILVER).count() == 5


def test_a_changed_schema_is_published(spark, tmp_path):
    for columns in (["id"], ["id", "id * 2 as twice"]):
        run = publish.start_run(spark, str(tmp_path))
        publish.save(spark.range(4).selectExpr(*columns), run, "t")
        publish.publish(spark, run, ["t"], "pub_changed")
        assert len(spark.table("pub_changed.t").columns) == len(columns) and spark.table("pub_changed.t").count() == 4


def star_tables(spark, root, n, database, **k):
    return build_star_tables(spark, raw_claims(spark, n, **k), code_list(spark, "D001"), seeds.state_codes(spark), str(root), database)


def test_star_is_declared_and_switched(spark, tmp_path):
    assert star_tables(spark, tmp_path, 4, "pub_star").loaded
    assert spark.table("pub_star.fact_claims").columns == STAR_TABLES["fact_claims"].fieldNames()
    assert "USING parquet" in spark.sql("SHOW CREATE TABLE pub_star.fact_claims").first()[0]
    assert star_tables(spark, tmp_path, 7, "pub_star").loaded
    assert spark.table("pub_star.fact_claims").count() == 7 and spark.table("pub_star.dim_patient").count() == 3


def test_a_failed_fact_write_leaves_the_old_star_whole(spark, tmp_path, monkeypatch):
    assert star_tables(spark, tmp_path, 4, "pub_kept").loaded
    before = publish.published(spark, str(tmp_path))
    real = publish.save

    def broken(df, run, name, *a, **k):
        if name == "fact_claims":
            df = df.withColumn("claim_id", F.raise_error(F.lit("disk full")).cast("string"))
        return real(df, run, name, *a, **k)

    monkeypatch.setattr(publish, "save", broken)
    with pytest.raises(Exception, match="disk full"):
        star_tables(spark, tmp_path, 9, "pub_kept")
    monkeypatch.undo()
    assert publish.published(spark, str(tmp_path)) == before
    read = {n: spark.table(f"pub_kept.{n}").count() for n in sinks.STAR_LOAD_ORDER}
    assert read == {"dim_patient": 3, "dim_provider": 2, "dim_diagnosis": 1, "fact_claims": 4}


def test_a_null_key_fails_the_write_and_publishes_nothing(spark, tmp_path):
    frames = {n: spark.createDataFrame([tuple(None if f.name.endswith("id") and n == "fact_claims" else (1.0 if f.dataType.typeName() == "double" else "x")
                                              for f in s.fields)], [f"{f.name}" for f in s.fields] and s.simpleString()[7:-1].replace(":", " ").replace(",", ", "))
              for n, s in STAR_TABLES.items()}
    run = publish.start_run(spark, str(tmp_path))
    with pytest.raises(Exception, match="fact_claims: NULL in NOT NULL column claim_id"):
        sinks.load_star(frames, run, "pub_null")
    assert not (tmp_path / "published").exists() and not spark.catalog.databaseExists("pub_null")
    frames["fact_claims"] = frames["fact_claims"].fillna("y")
    assert sinks.load_star(frames, publish.start_run(spark, str(tmp_path)), "pub_null")["fact_claims"] == 1
    assert spark.table("pub_null.fact_claims").count() == 1


def test_no_pass_before_the_star_write(spark):
    """NOT NULL is part of the write's plan."""
    plan = plan_of(sinks.required(spark.createDataFrame([("a", "b", "c")], "provider_id string, provider_state string, npi_number string"), "dim_provider"))
    assert "raise_error" in plan.lower()


# ------------------------------------------------------------- S14 on one run

def test_queries_are_answered_from_their_own_run(spark, tmp_path):
    small, large = models(spark, tmp_path / "a", 3), models(spark, tmp_path / "b", 8)
    spark.range(1).selectExpr("'view' as state", "0.0 as total_paid").createOrReplaceTempView("mart_claims_summary")
    text = "SELECT SUM(total_claims) AS n FROM mart_claims_summary"
    assert sql_audit.run_query(spark, text, database=small.run.schema).first().n == 3
    assert sql_audit.run_query(spark, text, database=large.run.schema).first().n == 8
    assert spark.catalog.currentDatabase() == "default"
    m = "SELECT a.state FROM mart_claims_summary a"
    for bad in (f"{m}, {small.run.schema}.int_claims_deduplicated b", f"{m}, int_claims_deduplicated b", f"{m}, stg_claims b",
                f"{m}, parquet.`{large.run.path(SILVER)}` b", f"{m}, range(5) b", f"{m} JOIN {small.run.schema}.mart_claims_summary b ON true"):
        with pytest.raises(sql_audit.GuardrailViolation):
            sql_audit.run_query(spark, bad, database=large.run.schema)


def test_run_views_are_of_the_run(spark, tmp_path):
    runs = [models(spark, tmp_path / str(n), n) for n in (2, 5)]
    assert [spark.table(r.run.table("stg_claims")).count() for r in runs] == [2, 5]
    assert spark.table(runs[0].run.table("stg_claims")).columns[0] == "claim_id"


# ------------------------------------------------------------ dense file order

def test_file_order_becomes_one_number(spark, tmp_path):
    """Files of several splits and sizes: numbers are gapless and in file order."""
    rng = random.Random(1)
    lines, k = [], 0
    (tmp_path / "in").mkdir()
    for f in range(5):
        own = []
        for _ in range(rng.randint(1, 400)):
            own.append(f"{k}|{'x' * rng.randint(1, 30)}")
            k += 1
        (tmp_path / f"in/part-{f}.csv").write_text("id|pad\n" + "\n".join(own) + "\n")
        lines += own
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        read = spark.read.option("header", True).option("sep", "|").csv(str(tmp_path / "in")).select("*", ingest.file_mark().alias("_seq"))
        assert ingest.is_marked(read, "_seq") and not ingest.is_marked(read, "id")
        read.write.parquet(str(tmp_path / "landed"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    landed = spark.read.parquet(str(tmp_path / "landed"))
    assert landed.select("_seq.file", "_seq.offset").distinct().count() > 5
    ingest.split_starts(landed, "_seq").write.parquet(str(tmp_path / "splits"))
    numbered = ingest.dense_order(landed, "_seq", spark.read.parquet(str(tmp_path / "splits")))
    assert dict(numbered.dtypes)["_seq"] == "bigint"
    assert [int(r.id) for r in numbered.orderBy("_seq").collect()] == list(range(k))
    assert sorted(r._seq for r in numbered.collect()) == list(range(k))


# ----------------------------------------------------------------- quarantine

def test_quarantine_scans_the_fact_once(spark, tmp_path):
    skewed_raw(spark).select(F.col("CLM_ID").alias("claim_id"), F.col("BENE_ID").alias("patient_id"), F.col("PRVDR_NUM").alias("provider_id"),
                             F.when(F.col("_ingest_seq") % 5 > 0, F.col("PRNCPAL_DGNS_CD")).alias("diagnosis_code"),
                             (F.col("CLM_PMT_AMT").cast("double") - 3).alias("claim_amount"), F.lit(1.0).alias("total_charges"),
                             F.when(F.col("_ingest_seq") % 9 > 0, F.col("CLM_FROM_DT")).alias("claim_from_date"), F.lit("t").alias("claim_thru_date"),
                             F.lit("1").alias("drg_code"), "_ingest_seq").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    with forced_shuffle(spark):
        told = quality.failed_checks(fact)
        told.collect()
        plan = told._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan
    columns = quality.output_columns(fact)
    for check in quality.CHECKS:
        want = sorted(map(str, quality.failed_rows(fact, check.name).select(*columns).collect()))
        assert sorted(map(str, told.where(F.col("check_name") == check.name).select(*columns).collect())) == want, check.name
    paths = quality.quarantine(fact, str(tmp_path / "q"))
    assert set(paths) == {"duplicate_claim_id", "negative_claim_amount", "null_diagnosis_code", "empty_claim_date"}
    assert sorted(p.name for p in (tmp_path / "q").iterdir() if not p.name.startswith(".")) == sorted(f"failed_{n}" for n in paths)
    again = quality.quarantine(fact.limit(0).union(fact.where("diagnosis_code is null").limit(3)), str(tmp_path / "q"))
    assert "null_diagnosis_code" in again
    assert quality.read_quarantine(spark, {"null_diagnosis_code": paths["null_diagnosis_code"]}, fact.select(*columns).schema).count() == 3


def test_quarantine_shuffles_no_column_twice_and_needs_no_report(spark, tmp_path, monkeypatch):
    rows = [("A", "p", "v", "d", 1.0, 1.0, "2020-01-01", "x", "1", 0), ("A", "p", "v", None, 1.0, 1.0, "2020-01-01", "x", "1", 1)]
    fact = spark.createDataFrame(rows, "claim_id string, patient_id string, provider_id string, diagnosis_code string, claim_amount double, "
                                       "total_charges double, claim_from_date string, claim_thru_date string, drg_code string, _ingest_seq long")
    with forced_shuffle(spark):
        plan = plan_of(quality.failed_checks(fact))
    assert plan.count("REPARTITION_BY_COL") == 2 and all("__claim" not in below.split("Exchange")[0] for below in plan.split("REPARTITION_BY_COL")[1:])
    monkeypatch.setattr(quality, "quality_report", None)  # no pass over the fact to find out which checks have rows
    paths = quality.quarantine(fact, str(tmp_path / "q"))
    assert set(paths) == {"duplicate_claim_id", "null_diagnosis_code"}
    assert sorted(p.name for p in (tmp_path / "q").iterdir() if not p.name.startswith(".")) == ["failed_duplicate_claim_id", "failed_null_diagnosis_code"]
    assert quality.quarantine(fact.limit(1), str(tmp_path / "q2")) == {}


def test_quarantine_query_writes_small_parts_without_a_sort(spark, tmp_path, monkeypatch):
    """Compressed parts hold the same rows; the write deals rows out by check without sorting them, and leaves the session as it was."""
    line = "id div 3 as l_orderkey, id % 7 as l_partkey, id % 2 as l_suppkey, cast(id % 3 as int) as l_linenumber, cast(id % 50 + 1 as double) as l_quantity, "
    line += "100.0D + id as l_extendedprice, 0.05D as l_discount, 0.01D * (id % 9) as l_tax, 'N' as l_returnflag, 'O' as l_linestatus, timestamp'2020-01-01' as l_shipdate"
    spark.range(300).selectExpr(*line.split(", ")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(100).selectExpr("id as o_orderkey", "id % 5 as o_custkey").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(2).selectExpr("id as s_suppkey", "id as s_nationkey").write.parquet(str(tmp_path / "supplier.parquet"))
    held, seen = spark.conf.get(sinks.WRITERS), []
    read = quality.read_quarantine
    monkeypatch.setattr(quality, "read_quarantine", lambda s, paths, schema: seen.append(paths) or read(s, paths, schema))
    monkeypatch.setattr(quality, "failed_checks", lambda fact, made=quality.failed_checks: seen.append(made(fact)) or seen[0])
    got = queries.queries()["qc_quarantine"](spark, str(tmp_path))
    assert spark.conf.get(sinks.WRITERS) == held and all(f.endswith(".csv.gz") for f in got.inputFiles()) and len(seen[1]) == 6
    want = seen[0].select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 200
    plans = []
    monkeypatch.setattr(type(want.write), "csv", lambda w, path: plans.append(spark.conf.get(sinks.WRITERS)))
    sinks.write_quarantine(want, str(tmp_path / "none"), [c.name for c in quality.CHECKS], True)
    assert int(plans[0]) >= len(quality.CHECKS) and spark.conf.get(sinks.WRITERS) == held


def test_duplicates_without_an_order(spark):
    rows = [("A", None), ("A", None), ("B", 4), ("B", None), ("B", 1), (None, 2), (None, 3)]
    fact = spark.createDataFrame([(c, "p", "v", "d", 1.0, 1.0, "2020-01-01", "x", "1", s) for c, s in rows],
                                 "claim_id string, patient_id string, provider_id string, diagnosis_code string, claim_amount double, "
                                 "total_charges double, claim_from_date string, claim_thru_date string, drg_code string, _ingest_seq long")
    told = quality.failed_checks(fact).where("check_name = 'duplicate_claim_id'")
    assert sorted(str(r.claim_id) for r in told.collect()) == ["B", "B", "None"]


# ------------------------------------------------------------------ J4, hot codes

def test_a_hot_code_is_spread(spark, tmp_path):
    """A third of the rows have no code; the list is too big to broadcast as a whole."""
    n = 30_000
    i = F.col("id")
    spark.range(n).select(i.cast("string").alias("claim_id"), F.when(i % 3 == 0, F.lit(" UNKNOWN ")).otherwise(
        F.concat(F.lit("D"), (i % 5000).cast("string"))).alias("diagnosis_code"), i.alias("_ingest_seq")).repartition(8).write.parquet(str(tmp_path / "c"))
    claims = spark.read.parquet(str(tmp_path / "c"))
    codes = spark.range(5000).select(F.concat(F.lit("D"), i.cast("string")).alias("code"), F.lit("text").alias("description"), F.lit("c").alias("category"))
    codes = codes.union(spark.sql("select 'UNKNOWN', 'not given', 'c'"))
    run = publish.start_run(spark, str(tmp_path / "run"))
    seen = publish.save(claims, run, "claims_clean", {"codes": star.frequent_codes()})
    hot = star.hot_codes(seen["codes"], seen["rows"])
    assert hot == ["UNKNOWN"]
    plain = star.join_descriptions(claims, codes)
    with forced_shuffle(spark, "spark.sql.adaptive.coalescePartitions.enabled"):
        spread = star.join_descriptions(claims, codes, hot)
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert "BroadcastHashJoin" in plan_of(spread) and "SortMergeJoin" in plan_of(spread)
        rows = sorted(map(str, spread.select(*plain.columns).collect()))
    assert rows == sorted(map(str, plain.collect()))
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2], sizes


def test_a_hot_code_listed_too_often_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(star, "HOT_ENTRIES", 3)
    claims = spark.createDataFrame([(str(k), "H", k) for k in range(6)], "claim_id string, diagnosis_code string, _ingest_seq long")
    codes = spark.createDataFrame([("H", f"d{k}", "c") for k in range(5)], "code string, description string, category string")
    assert star.join_descriptions(claims, codes, ["H"]).count() == 30
    monkeypatch.setattr(star, "HOT_ENTRIES", 5)
    assert star.join_descriptions(claims, codes, ["H"]).count() == 30


# -------------------------------------------------------------------- T1, ranks

def test_ranks_are_global_and_gapless(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000).cast("double").alias("total_cost"), F.col("id").cast("string").alias("diagnosis_code"),
                                  F.lit("d").alias("diagnosis_description"), F.lit("c").alias("diagnosis_category")).repartition(9)
    df = df.withColumn("total_cost", F.when(F.col("total_cost") > 5, F.col("total_cost")))
    got = [r.rank for r in marts.order_by_cost(marts.ranked_by_cost(df)).collect()]
    assert got == list(range(1, 5001))
    assert "SinglePartition" not in plan_of(marts.ranked_by_cost(df).select("rank").where("rank < 10")) .split("Window")[0]
    assert ranking.global_rank(df.limit(0), [F.col("total_cost")]).count() == 0


# ----------------------------------------------------------------- claims cleaned as they are read

def test_numbers_of_left_rows_keep_the_file_order(spark):
    """Of each split only some rows are left: their numbers differ and sort in file order."""
    rows = [("b", 0, 7), ("b", 0, 9), ("a", 50, 2), ("a", 50, 40), ("a", 0, 1 << 33), ("a", 0, (1 << 33) + 30), ("a", 0, (1 << 33) + 90)]
    left = spark.createDataFrame(rows, "file string, offset long, row long").select(F.struct("file", "offset", "row").alias("_seq"))
    got = ingest.dense_order(left.withColumn("mark", F.col("_seq")), "_seq", ingest.split_starts(left, "_seq")).collect()
    assert len({r._seq for r in got}) == len(rows)
    assert [tuple(r.mark) for r in sorted(got, key=lambda r: r._seq)] == sorted(rows)


def test_the_star_run_lands_cleaned_claims_only(spark, sf_small, tmp_path):
    """The text is cleaned as it is read, so no copy of all its rows is written; the
    first row of a claim is that of the file, by the row's number."""
    from carelake.contracts import queries as Q
    claims = Q._write_claims_csv(spark, sf_small)
    assert [f for f in os.listdir(claims.removeprefix("file:")) if f.endswith(".csv.lz4")]
    res = run_star(spark, claims, Q._write_icd_csv(spark, sf_small), str(tmp_path / "s"))
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {res.run.schema}").collect()}
    assert "claims_clean" in names and "claims_text" not in names
    fact = spark.read.parquet(res.tables["claims_v1"])
    order = fact.selectExpr("_ingest_seq._ingest_seq n", "cast(claim_id as long) id").distinct().orderBy("n").collect()
    assert len(order) > 1000 and [r.id for r in order] == sorted(r.id for r in order)
