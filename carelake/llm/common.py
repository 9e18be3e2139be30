"""Shared helpers: written intermediate tables, row keys, input reading.

Conventions that every operator of this package keeps:

* An input row is carried as one struct (``ROW``), so extra input columns can
  have any name without meeting an operator's own columns. When an output
  column has the name of an input column, the output takes its place.
* Null text is read as the empty text.
* A frame that is read more than once is written once, as a table below
  ``spark.checkpoint.dir`` (shared by driver and executors), so a lost
  executor costs the tasks it held and never a different result.
"""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.session import scratch_path

ROW = "_row"
KEY = "_row_key"

# ASCII white space that separates words, as a Java character class.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array (no empty strings)."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often used."""
    return F.transform(F.array(value), body)[0]


# The list that gathers the scratch tables of the caller, if it wants them.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def collect_written() -> Iterator[list[str]]:
    """The scratch tables that are written inside, by this thread: runs in other
    threads have lists of their own."""
    paths: list[str] = []
    token = _WRITTEN.set(paths)
    try:
        yield paths
    finally:
        _WRITTEN.reset(token)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no frame will read any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def parts_for(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions of about ``each`` rows, and one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // each))


def materialise(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back. With
    ``parts``, in so many files at most: every task that writes creates folders and a
    file, and on a local file system starts processes for their permissions, so
    small tables that are written often must not have a file for each shuffle partition."""
    spark = df.sparkSession
    df = df.coalesce(parts) if parts else df
    path = scratch_path(spark, name)
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs now: it acts
    when the driver's garbage is collected, which small plans put off. The
    frames let go of here hold the plans there."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unpack(df: DataFrame, outputs: list[str]) -> DataFrame:
    """The columns of ``ROW`` but those named like an output, then the outputs."""
    taken = {n.lower() for n in outputs}
    kept = [f for f in df.schema[ROW].dataType.names if f.lower() not in taken]
    return df.select(*[F.col(ROW)[f].alias(f) for f in kept], *outputs)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(), f"{top.name}-py.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for f in sorted(top.rglob("*.py")):
            out.write(f, f.relative_to(top.parent))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


# Spark's own limit, 64 MB, is held several times by each task, in the JVM and in its Python worker.
BATCH_BYTES = 4 << 20


def map_arrow(df: DataFrame, body, schema) -> DataFrame:
    """``mapInArrow`` with a body from this package, in batches of about ``BATCH_BYTES``
    (a setting of the session, as the frame may be run at any later time)."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(body, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches small enough to hold as Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
