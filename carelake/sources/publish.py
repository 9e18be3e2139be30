"""Runs and their publication (S7-S10): a run writes into a schema of its own, and
readers change over to it when all of it is there.

* Every run has a catalog schema whose folder is ``<root>/runs/<run>``. Nothing in it
  replaces anything: a run that fails leaves the tables that are read as they were.
* ``publish`` first appends the run to the log ``<root>/published`` (one small file, so
  its tables appear there together), then points the tables of the published
  schema at the run's folders, in the order given. A catalog switches one table
  at a time; ``published`` and ``read_published`` go by the log and switch at once.
* ``drop_run`` removes a run that is no longer read.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "run string, at timestamp, name string, path string"


@dataclass(frozen=True)
class Run:
    id: str
    root: str

    @property
    def schema(self) -> str:
        return f"run_{self.id}"

    @property
    def folder(self) -> str:
        return f"{self.root}/runs/{self.id}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"


def _text(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def start_run(spark: SparkSession, root: str) -> Run:
    """A new run below ``root``; ids of later runs sort after earlier ones."""
    run = Run(f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}", root.rstrip("/"))
    spark.sql(f"CREATE DATABASE {run.schema} LOCATION {_text(run.folder)}")
    return run


def save(df: DataFrame, run: Run, name: str, metrics: dict[str, Column] | None = None,
         buckets: tuple[int, str] | None = None) -> dict:
    """Write ``df`` as table ``name`` of the run and return what the write itself
    counted: its ``rows`` and the aggregates ``metrics``.

    The observation is the last thing before the files, in the stage that writes
    them. Spark adds a partition of that stage once, so a task that is run again
    after a lost executor is not counted twice. With ``buckets`` (number, column) the
    files are hashed and sorted by the column, as ``df`` should be already.
    """
    seen = Observation(name)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()]).write.format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets[0], buckets[1]).sortBy(buckets[1])
    writer.saveAsTable(run.table(name))
    return seen.get


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" + ("" if f.nullable else " NOT NULL") for f in schema.fields)


def _point(spark: SparkSession, name: str, run: Run, database: str, declared: T.StructType | None) -> None:
    """Make ``database.name`` read the run's files: by its location where the columns
    are the same, else by a new entry. No data moves."""
    full, at = f"{database}.{name}", _text(run.path(name))
    columns = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    new = spark.table(run.table(name)).schema
    if spark.catalog.tableExists(full):
        if columns(spark.table(full).schema) == columns(declared or new):
            spark.sql(f"ALTER TABLE {full} SET LOCATION {at}")
            spark.catalog.refreshTable(full)
            return
        spark.sql(f"DROP TABLE {full}")
    if declared is None:
        spark.sql(f"CREATE TABLE {full} LIKE {run.table(name)} LOCATION {at}")
    else:
        spark.sql(f"CREATE TABLE {full} ({_ddl(declared)}) USING parquet LOCATION {at}")


def publish(spark: SparkSession, run: Run, names: list[str], database: str | None = None,
            declared: dict[str, T.StructType] | None = None) -> None:
    """Let readers see tables ``names`` of a finished run: in the log of its root and,
    with ``database``, as tables of it (declared with a schema where one is given)."""
    rows = ", ".join(f"('{run.id}', '{n}', {_text(run.path(n))})" for n in names)
    log = spark.sql(f"SELECT * FROM VALUES {rows} AS t(run, name, path)").coalesce(1)
    log.select("run", F.current_timestamp().alias("at"), "name", "path").write.mode("append").parquet(f"{run.root}/published")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {_text(f'{run.root}/schemas/{database}')}")
        for name in names:
            _point(spark, name, run, database, (declared or {}).get(name))


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name -> path of the run published last (a row for each of its tables)."""
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{root.rstrip('/')}/published")
    last = log.agg(F.max("run")).first()[0]
    return {r["name"]: r["path"] for r in log.where(F.col("run") == last).collect()}


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(published(spark, root)[name])


def drop_run(spark: SparkSession, run: Run) -> None:
    """Remove a run's tables and files; refused while it is the one published last."""
    try:
        current = set(published(spark, run.root).values())
    except Exception as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        current = set()
    if any(p.startswith(f"{run.folder}/") for p in current):
        raise ValueError(f"run {run.id} is published")
    spark.sql(f"DROP DATABASE IF EXISTS {run.schema} CASCADE")
