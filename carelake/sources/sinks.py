"""Writes. Every write is a full overwrite (daily full
refresh); written tables also cut the lineage of what reads them next."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.schemas import STAR_TABLES
from carelake.sources.publish import Run, _ddl, publish, save

# Load order of the star: dimensions before the fact.
STAR_LOAD_ORDER = ["dim_patient", "dim_provider", "dim_diagnosis", "fact_claims"]


# Fields are quoted, and quotes in them doubled, as CSV readers expect.
QUOTING = {"quote": '"', "escape": '"'}
KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                table: str | None = None) -> str:
    """Overwrite a table at ``path`` (parquet by default), under the
    catalog name ``table`` where given."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return path


def run_concurrently(actions: dict[str, Callable], max_parallel: int = 4) -> dict:
    """Run independent actions as concurrent Spark jobs (one driver thread each), so
    small jobs share the cluster instead of queueing; name -> result."""
    if len(actions) <= 1:
        return {name: act() for name, act in actions.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(actions))) as pool:
        futures = {name: pool.submit(act) for name, act in actions.items()}
        return {name: f.result() for name, f in futures.items()}


def write_claims_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """The raw claims layout: '|'-separated text with a header line. A compressed part
    file is read back by one task."""
    (df.write.mode("overwrite").option("header", True).option("sep", "|").option("compression", compression)
       .options(**QUOTING, **KEEP_BLANKS).csv(path))
    return path


def write_icd_source_csv(df: DataFrame, path: str) -> str:
    """The six-column headerless code list (quoted where needed)."""
    df.write.mode("overwrite").option("header", False).option("sep", ",").options(**QUOTING, **KEEP_BLANKS).csv(path)
    return path


def create_star_tables(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for the four star tables as parquet
    tables at ``root/<name>``. Parquet does not enforce NOT NULL; :func:`required`
    does, in the write."""
    names = []
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    for name, schema in STAR_TABLES.items():
        full = f"{database}.{name}" if database else name
        spark.sql(f"CREATE TABLE IF NOT EXISTS {full} ({_ddl(schema)}) USING parquet LOCATION '{root}/{name}'")
        names.append(full)
    return names


class NullKeyError(ValueError):
    """A NOT NULL column of a star table holds NULLs."""


def check_not_null(tables: dict[str, DataFrame]) -> None:
    """Fail when a declared NOT NULL column has NULLs (one pass per table)."""
    for name, df in tables.items():
        keys = [f.name for f in STAR_TABLES[name].fields if not f.nullable]
        if not keys:
            continue
        row = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys]).first()
        bad = {k: row[k] for k in keys if row[k]}
        if bad:
            raise NullKeyError(f"{name}: NULL in NOT NULL columns {bad}")


def required(df: DataFrame, name: str) -> DataFrame:
    """The columns of star table ``name``; a NULL in a NOT NULL column fails whatever
    job writes the rows (parquet does not enforce it), without a pass of its own."""
    fields = STAR_TABLES[name].fields
    refuse = lambda f: F.raise_error(F.lit(f"{name}: NULL in NOT NULL column {f.name}")).cast(f.dataType)
    return df.select(*[F.col(f.name) if f.nullable else F.coalesce(F.col(f.name), refuse(f)).alias(f.name) for f in fields])


def load_star(tables: dict[str, DataFrame], run: Run, database: str | None = None) -> dict[str, int]:
    """Write the dimensions, then the fact, as tables of ``run``, and only then
    switch what is read to them. Returns the rows of each; any failure before the
    end, a NULL key included, leaves the star before it as it was."""
    spark = tables[STAR_LOAD_ORDER[0]].sparkSession
    rows = {name: save(required(tables[name], name), run, name)["rows"] for name in STAR_LOAD_ORDER}
    publish(spark, run, STAR_LOAD_ORDER, database, declared=STAR_TABLES)
    return rows


# NULL and the empty string are different findings; keep them apart in text.
_QUARANTINE = {"header": "true", "nullValue": "\\N", **QUOTING}


# Writers a task of the quarantine's write may hold open, one for each check: with
# room for all, Spark does not sort the rows of a task by check first.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_quarantine(failed: DataFrame, root: str, checks: list[str], found_only: bool = False,
                     compression: str = "none") -> dict[str, str]:
    """Rows of ``failed`` by their ``check_name`` as headered CSV folders
    ``root/failed_<check>``, for the ``checks`` that have rows (with ``found_only``,
    those of them that turn out to have any). One write deals the
    rows out by check in a folder of its own; its parts are then renamed, so a
    write that fails leaves what was there. The reader knows ``compression`` by the
    names of the parts."""
    spark = failed.sparkSession
    work = f"{root.rstrip('/')}/_writing_{uuid.uuid4().hex}"
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(max(len(checks), int(before))))
    try:
        failed.write.partitionBy("check_name").option("compression", compression).options(**_QUARANTINE, **KEEP_BLANKS).csv(work)
    finally:
        spark.conf.set(WRITERS, before)
    paths = {name: f"{root.rstrip('/')}/failed_{name}" for name in checks}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(work).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if found_only:
        paths = {name: path for name, path in paths.items() if fs.exists(hadoop(f"{work}/check_name={name}"))}
    for name, path in paths.items():
        fs.delete(hadoop(path), True)
        if not fs.rename(hadoop(f"{work}/check_name={name}"), hadoop(path)):
            raise OSError(f"no rows of {name} in {work}")
    fs.delete(hadoop(work), True)
    spark.sparkContext._jvm.System.gc()  # lets go of the write's shuffle files, before the parts are read
    return paths


def quarantine_reader(spark: SparkSession, schema):
    return spark.read.schema(schema).options(**_QUARANTINE)
