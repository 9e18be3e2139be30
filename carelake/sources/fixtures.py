"""Adapters that shape the TPC-H-like test tables as claims inputs.

The reference ships no claims data, so the test tables are re-shaped into
the raw claims file, the ICD code list, a dirty fact table and a SQL query
log. Each adapter is a plain join/projection over the given tables, so its
size grows with them; the same relations are written in SQL for the DuckDB
oracle (see ``carelake.contracts.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.sources.claims_csv import INGEST_ORDER
from carelake.sources.icd_csv import ICD_INGEST_ORDER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _paid_amount() -> Column:
    """price * (1 - discount) computed exactly in DECIMAL, then as DOUBLE:
    exact to 4 decimals, and free of NaN and -0.0."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    # decimal(12,2) * decimal(5,2) -> decimal(18,4): exact, and small enough
    # for Spark's long-backed decimal arithmetic.
    return (price * (F.lit(1).cast("decimal(3,2)") - discount)).cast("double")


def _ingest_seq() -> Column:
    """File order of the synthetic claims file (unique at every scale; no floating
    point in it, which Spark would normalise, and deal out anew, before a join)."""
    return F.struct("l_orderkey", "l_linenumber", "l_shipdate", "l_suppkey",
                    "l_partkey", F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice")).alias(INGEST_ORDER)


def _claims_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The join on the order key needs this partitioning anyway; made explicit,
    # it also spreads a table that is one file.
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").repartition("l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Both joins are left to the planner: orders grows with lineitem and
    # supplier grows with the scale factor, so neither has a fixed bound.
    return (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))


def _raw_columns() -> list[Column]:
    q = F.col("l_quantity")
    paid = _paid_amount()
    ship = F.col("l_shipdate")
    return [
        _s(F.col("l_orderkey")).alias("CLM_ID"),
        _s(F.col("o_custkey")).alias("BENE_ID"),
        F.when(q != 50, _s(F.col("l_suppkey"))).alias("PRVDR_NUM"),
        _s(F.col("l_linenumber")).alias("CLM_LINE_NUM"),
        # One part key in eleven has a code that no list holds.
        F.when(F.col("l_tax") < 0.08,
               F.concat(F.when(F.col("l_partkey") % 11 == 0, F.lit("X")).otherwise(F.lit("D")),
                        F.lpad(_s(F.col("l_partkey")), 9, "0"))).alias("PRNCPAL_DGNS_CD"),
        _s(F.col("l_partkey") % 50).alias("CLM_DRG_CD"),
        _s(F.when(q == 49, F.lit(None).cast("double")).when(q == 48, -paid).otherwise(paid)).alias("CLM_PMT_AMT"),
        _s(F.when(q == 47, F.lit(None).cast("double")).when(q == 46, F.lit(0.0))
            .otherwise(F.col("l_extendedprice"))).alias("CLM_TOT_CHRG_AMT"),
        # Days as text are yyyy-MM-dd; no time of day is made and formatted.
        _s(ship.cast("date")).alias("CLM_FROM_DT"),
        _s(F.date_add(ship.cast("date"), F.col("l_linenumber"))).alias("CLM_THRU_DT"),
        F.when(F.col("s_nationkey") % 8 == 7, F.lit("XX"))
         .otherwise(_s(F.col("s_nationkey") * 3)).alias("PRVDR_STATE_CD"),
        F.concat(F.lit("NPI"), _s(F.col("l_suppkey"))).alias("ORG_NPI_NUM"),
        F.col("l_linestatus").alias("PTNT_DSCHRG_STUS_CD"),
        F.col("l_returnflag").alias("CLM_IP_ADMSN_TYPE_CD"),
    ]


def claims_raw(spark: SparkSession, sf_dir: str, ingest_order: bool = True) -> DataFrame:
    """The bronze claims relation: the 14 used raw columns, all STRING,
    plus the hidden ``_ingest_seq`` file-order key."""
    cols = _raw_columns() + ([_ingest_seq()] if ingest_order else [])
    return _claims_base(spark, sf_dir).select(*cols)


# The columns of the base that a raw claim is made of.
_CLAIM_SOURCE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "o_custkey", "s_nationkey"]


def _wide_columns() -> list[Column]:
    used = _raw_columns()
    fillers = {
        0: _s(F.col("l_quantity")).alias("NCH_NEAR_LINE_REC_IDENT_CD"),
        3: F.concat(F.lit('a|"b" \\'), F.col("l_returnflag"), F.lit(' "c"')).alias("CLM_SRVC_CLSFCTN_TYPE_CD"),
        7: _s(F.col("l_tax")).alias("NCH_PRMRY_PYR_CLM_PD_AMT"),
        11: _s(F.col("l_discount")).alias("CLM_UTLZTN_DAY_CNT"),
    }
    cols = []
    for i, c in enumerate(used):
        if i in fillers:
            cols.append(fillers[i])
        cols.append(c)
    return cols


def claims_raw_wide(spark: SparkSession, sf_dir: str, ingest_order: bool = False) -> DataFrame:
    """The raw claims relation with unused columns before and between the
    used ones, as in the real 197-column file (for CSV round trips)."""
    return _claims_base(spark, sf_dir).select(*_wide_columns(), *([_ingest_seq()] if ingest_order else []))


def _claims_in_key_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`_claims_base`, dealt out once, by ranges of the order key.

    Lines and orders are dealt out together, and a line finds its orders among the rows
    of its key: one shuffle gives the join and the ranges of a file in key order."""
    li = table(spark, sf_dir, "lineitem").select(*[c for c in _CLAIM_SOURCE if c.startswith("l_")])
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = li.where("l_orderkey is not null").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
    orders = table(spark, sf_dir, "orders").where("o_orderkey is not null").select(
        F.col("o_orderkey").alias("l_orderkey"), F.struct("o_custkey").alias("__order"))
    dealt = lines.unionByName(orders, allowMissingColumns=True).repartitionByRange("l_orderkey")
    met = dealt.withColumn("__orders", F.collect_list("__order").over(Window.partitionBy("l_orderkey")))
    return (met.where("__order is null").withColumn("__found", F.explode("__orders"))
               .withColumn("o_custkey", F.col("__found.o_custkey")).select(*_CLAIM_SOURCE))


def claims_file_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`claims_raw_wide` in file order: partitions follow each other, each sorted.

    The rows are dealt out and sorted as the numbers they are made of; the wide
    text is made from them afterwards, where they are written."""
    order = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_shipdate"), F.col("l_suppkey"), F.col("l_partkey"),
             F.col("l_extendedprice").cast("decimal(12,2)")]  # the fields of _ingest_seq
    return _claims_in_key_ranges(spark, sf_dir).sortWithinPartitions(*order).select(*_wide_columns())


def mixed_dates() -> Column:
    """The from-date of a raw claim in one of the three forms of the raw files by its
    line number; one claim in 41 has a date that is none. The newest date of each form differs."""
    day, line = F.col("CLM_FROM_DT").cast("date"), F.col("CLM_LINE_NUM").cast("int")
    return (F.when(F.col("CLM_ID").cast("bigint") % 41 == 0, F.concat(F.col("CLM_FROM_DT"), F.lit("?")))
             .when(line % 3 == 0, F.date_format(day, "yyyyMMdd")).when(line % 3 == 1, F.date_format(day, "dd-MMM-yyyy"))
             .otherwise(F.col("CLM_FROM_DT")))


def fact_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the quality checks: the nine fact columns from the raw
    relation, unfiltered, with nulls and empty dates injected, plus the
    file-order key ``_ingest_seq`` that decides which duplicate is first."""
    base = _claims_base(spark, sf_dir)
    raw = base.select(*_raw_columns(), "l_quantity", _ingest_seq())
    q = F.col("l_quantity")
    return raw.select(
        F.when(q != 1, F.col("CLM_ID")).alias("claim_id"),
        F.when(q != 4, F.col("BENE_ID")).alias("patient_id"),
        F.col("PRVDR_NUM").alias("provider_id"),
        F.col("PRNCPAL_DGNS_CD").alias("diagnosis_code"),
        F.col("CLM_PMT_AMT").cast("double").alias("claim_amount"),
        F.col("CLM_TOT_CHRG_AMT").cast("double").alias("total_charges"),
        F.when(q == 2, F.lit("")).when(q == 3, F.lit("nan")).when(q == 5, F.lit(None).cast("string"))
         .otherwise(F.col("CLM_FROM_DT")).alias("claim_from_date"),
        F.col("CLM_THRU_DT").alias("claim_thru_date"),
        F.col("CLM_DRG_CD").alias("drg_code"),
        F.col(INGEST_ORDER),
    )


def _icd_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")


def _icd_code() -> Column:
    """One code per part, but every 20th part repeats the code before it and
    every 37th has none; every third is in lower case."""
    k = F.col("p_partkey")
    prefix = F.when(k % 3 == 0, F.lit(" d")).otherwise(F.lit(" D"))
    number = F.when(k % 20 == 0, k - 1).otherwise(k)
    return F.when(k % 37 != 0, F.concat(prefix, F.lpad(_s(number), 9, "0"),
                                        F.when(k % 13 == 0, F.lit("\u2003")).otherwise(F.lit(" "))))


def _icd_description() -> Column:
    """Padded, with a no-break space at times; some hold commas, quotes and a backslash."""
    k = F.col("p_partkey")
    return F.concat(F.lit(" "), F.col("p_name"), F.when(k % 5 == 0, F.lit(', "so called", \\')).otherwise(F.lit("")),
                    F.when(k % 7 == 0, F.lit("\u00a0")).otherwise(F.lit(" ")))


def icd_codes_raw(spark: SparkSession, sf_dir: str, ingest_order: bool = True) -> DataFrame:
    """The ICD code list as loaded (code, description, category): padded,
    partly lower-case codes, NULL codes and doubled codes."""
    cols = [_icd_code().alias("code"),
            _icd_description().alias("description"),
            F.col("p_type").alias("category")]
    if ingest_order:
        cols.append(F.col("p_partkey").alias(ICD_INGEST_ORDER))
    return _icd_part(spark, sf_dir).select(*cols)


def icd_source_six(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six-column headerless layout of the code list; the long
    description holds a comma, so the CSV writer has to quote it."""
    k = F.col("p_partkey")
    return _icd_part(spark, sf_dir).select(
        F.concat(F.lit("C"), F.lpad(_s(k % 10), 2, "0")).alias("category_code"),
        _s(k).alias("sub_code"),
        _icd_code().alias("icd10_code"),
        _icd_description().alias("short_description"),
        F.concat(F.col("p_name"), F.lit(", "), F.col("p_brand")).alias("long_description"),
        F.col("p_type").alias("category"),
    )


# Statement shapes of the query log -- the five guardrail
# self-check statements and the further cases of FIXTURES.md section 4.
# {k} {n} {s} are filled from the order row, so every order yields one
# statement and the log grows with the orders table.
SQL_LOG_TEMPLATES = [
    "SELECT state, total_paid FROM mart_claims_summary ORDER BY total_paid DESC LIMIT {k}",
    "DELETE FROM mart_claims_summary WHERE state = '{s}'",
    "SELECT * FROM mart_claims_summary; DROP TABLE mart_claims_summary;",
    "SELECT * FROM stg_claims LIMIT {k}",
    "SELECT provider_id, total_paid FROM mart_provider_performance ORDER BY total_paid DESC",
    "WITH t AS (SELECT * FROM mart_claims_summary WHERE total_claims > {n}) SELECT * FROM t",
    "SELECT EXTRACT(YEAR FROM claim_month) AS y FROM mart_claims_summary LIMIT {k}",
    "SELECT a.provider_id FROM mart_provider_performance a, provider_notes b WHERE a.total_claims > {n}",
    "SELECT {n} AS answer",
    "SELECT * FROM (SELECT * FROM mart_diagnosis_cost_analysis ORDER BY total_cost DESC LIMIT {k}) x",
    "SELECT * FROM MART_CLAIMS_SUMMARY WHERE total_claims > {n}",
    "EXPLAIN SELECT * FROM mart_claims_summary",
    "SELECT diagnosis_code FROM mart_diagnosis_cost_analysis WHERE claim_count > {n};  ",
    "  select state from `analytics.marts.mart_claims_summary` where state = '{s}'",
    "SELECT * FROM my-project.marts.mart_claims_summary LIMIT {k}",
    "SELECT state FROM mart_claims_summary WHERE state = 'drop {s}'",
    "```sql\nSELECT s.state, p.provider_id FROM mart_claims_summary s\n"
    "JOIN mart_provider_performance p ON s.state = p.provider_state\n```",
    "```\nselect * from mart_provider_performance where updated_flag = '{s}'\n```",
    "SELECT * FROM mart_claims_summary s LEFT JOIN stg_icd_codes i ON s.diagnosis_code = i.diagnosis_code",
    "SELECT selected_state FROM mart_claims_summary WHERE note = 'created by {s}' LIMIT {k}",
    "SELECT state FROM mart_claims_summary UNION ALL SELECT state FROM\u00a0stg_claims LIMIT {k}",
    "\u2003SELECT state FROM\u2003mart_claims_summary WHERE total_claims > {n}\u00a0",
    "SELECT state FROM mart_claims_summary WHERE total_claims > {n} LIMIT\u00a0{k}",
]


def sql_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query log (query_id, sql_text): one statement per order, shape
    chosen by the order key, parameters taken from the order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    shape = (F.col("o_orderkey") % len(SQL_LOG_TEMPLATES)).cast("int")
    k = _s(F.col("o_custkey") % 20 + 1)
    n = _s(F.col("o_custkey") % 1000)
    s = F.col("o_orderpriority")
    branches = None
    for i, tpl in enumerate(SQL_LOG_TEMPLATES):
        text = _fill(tpl, {"k": k, "n": n, "s": s})
        branches = F.when(shape == i, text) if branches is None else branches.when(shape == i, text)
    return orders.select(F.col("o_orderkey").alias("query_id"), branches.alias("sql_text"))


def _fill(template: str, params: dict[str, Column]) -> Column:
    """Build concat(...) for a template with {name} placeholders."""
    parts: list[Column] = []
    rest = template
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        j = rest.index("}", i)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(params[rest[i + 1:j]])
        rest = rest[j + 1:]
    return F.concat(*parts) if len(parts) > 1 else parts[0]
