"""Scale properties of the plans (docs/PLANS.md), checked on the physical
plan so a later change cannot silently add a shuffle or move a join."""

import re

from pyspark.sql import functions as F

from carelake.operators import dedup, marts, questions, sql_audit, staging
from carelake.sources import fixtures, seeds
from tests.test_skew import skewed_raw


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return [line.strip() for line in plan.split("\n") if "Exchange hashpartitioning" in line
            or "Exchange SinglePartition" in line or "Exchange rangepartitioning" in line]


def claims(spark):
    return dedup.int_claims_deduplicated(staging.stg_claims(skewed_raw(spark)))


def icd(spark):
    return spark.createDataFrame([("D001", "hot", "c")], "diagnosis_code string, diagnosis_description string, "
                                                         "diagnosis_category string")


def test_icd_join_sits_above_a_finished_aggregation(spark):
    plan = plan_of(marts.claims_summary(claims(spark), icd(spark), seeds.state_codes(spark)))
    lines = plan.split("\n")
    icd_join = next(i for i, line in enumerate(lines) if "LeftOuter" in line and "diagnosis_code" in line)
    below = "\n".join(lines[icd_join:])
    # a complete (final) aggregation of the claims feeds the join
    assert re.search(r"HashAggregate\(keys=\[[^\]]*provider_state_code[^\]]*diagnosis_code", below)
    assert "partial_count(" in below


def test_provider_mart_has_one_shuffle_after_dedup(spark):
    plan = plan_of(marts.provider_performance(claims(spark), seeds.state_codes(spark)))
    ex = exchanges(plan)
    # dedup's exchange on claim_id, the input repartition, and the aggregation's exchange
    assert sum("claim_id" in e for e in ex) == 1
    assert sum("provider_id" in e for e in ex) == 1
    assert "BroadcastHashJoin" in plan


def test_distinct_count_reuses_dedup_partitioning(spark):
    plan = plan_of(questions.kpi_totals(claims(spark)))
    ex = exchanges(plan)
    assert sum("claim_id" in e for e in ex) == 1        # only the dedup's own exchange


def test_audit_is_narrow(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("query_id"),
                            F.concat(F.lit("SELECT * FROM mart_claims_summary LIMIT "), F.col("id")).alias("sql_text")) \
        .write.parquet(str(tmp_path / "log"))
    plan = plan_of(sql_audit.audit_sql(spark.read.parquet(str(tmp_path / "log"))))
    assert not exchanges(plan)


def test_the_claims_file_is_dealt_out_before_its_text_is_made(spark, tmp_path):
    """The range shuffle of the claims file carries the numbers of a row, not the wide text;
    the file's rows and their order are those of the relation in file order."""
    day = F.lit("2020-01-01").cast("timestamp")
    i = F.col("id")
    spark.range(400).select((i * 7 % 90).alias("l_orderkey"), (i % 40).alias("l_partkey"), (i % 5).alias("l_suppkey"), (i % 7).cast("int").alias("l_linenumber"),
                            (i % 50).cast("double").alias("l_quantity"), (i / 4).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"),
                            F.lit(0.02).alias("l_tax"), F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate")) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(90).select(i.alias("o_orderkey"), (i % 9).alias("o_custkey")).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(5).select(i.alias("s_suppkey"), i.alias("s_nationkey")).write.parquet(str(tmp_path / "supplier.parquet"))
    wide = fixtures.claims_file_wide(spark, str(tmp_path))
    plan = plan_of(wide).split("Exchange rangepartitioning")
    assert len(plan) == 2 and "AS CLM_ID" in plan[0] and "AS CLM_ID" not in plan[1]
    want = fixtures.claims_raw_wide(spark, str(tmp_path), ingest_order=True).orderBy("_ingest_seq").drop("_ingest_seq")
    assert [tuple(r) for r in wide.collect()] == [tuple(r) for r in want.collect()]


def test_the_claims_file_is_dealt_out_once(spark, tmp_path):
    """Lines and orders are dealt out by ranges of the order key, and by nothing else; repeated
    and NULL keys on either side give the rows of the join."""
    lines = [(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 1, 0), (3, 1, 1), (None, 1, 1), (4, 1, 9), (5, 1, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long").selectExpr(
        "l_orderkey", "7L l_partkey", "l_suppkey", "l_linenumber", "10D l_quantity", "2.5D l_extendedprice", "0.05D l_discount", "0.02D l_tax",
        "'N' l_returnflag", "'O' l_linestatus", "timestamp'2020-01-01' l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 11), (1, 12), (1, None), (2, 13), (2, 13), (None, 14), (4, 15), (5, 16), (6, 17)],
                          "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(0, 1), (0, 2), (1, 3), (None, 4)], "s_suppkey long, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    wide = fixtures.claims_file_wide(spark, str(tmp_path))
    assert len(exchanges(plan_of(wide))) == 1
    got, want = wide.collect(), fixtures.claims_raw_wide(spark, str(tmp_path)).collect()
    assert len(got) == 13 and sorted(map(str, got)) == sorted(map(str, want))
    assert [r.CLM_ID for r in got] == ["1"] * 9 + ["2"] * 4
