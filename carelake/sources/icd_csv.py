"""The ICD-10 code list.

The source file is headerless, comma separated, with six positional
columns; only the full code (3rd), the short description (4th) and the
category (6th) are kept, as ``code, description, category``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.schemas import ICD_SOURCE_SCHEMA
from carelake.sources.ingest import file_mark
from carelake.sources.sinks import KEEP_BLANKS, QUOTING

ICD_INGEST_ORDER = "_icd_seq"


def read_icd_source(spark: SparkSession, path: str) -> DataFrame:
    """The six-column file, all STRING. The schema binds by position,
    which is right here because the file has no header. Quoted fields may
    contain commas."""
    return (spark.read.schema(ICD_SOURCE_SCHEMA)
            .option("header", False).option("sep", ",")
            .options(**QUOTING).option("mode", "FAILFAST")
            .csv(path))


def icd_projection(source: DataFrame, ingest_order: bool = False) -> DataFrame:
    """S3: keep columns 3, 4 and 6 as ``code, description, category``."""
    cols = [F.col("icd10_code").alias("code"),
            F.col("short_description").alias("description"),
            F.col("category")]
    if ingest_order:
        cols.append(file_mark().alias(ICD_INGEST_ORDER))
    return source.select(*cols)


def read_icd_csv(spark: SparkSession, path: str, ingest_order: bool = False) -> DataFrame:
    """S2 + S3: read the code list and project it to (code, description, category)."""
    return icd_projection(read_icd_source(spark, path), ingest_order)


def write_icd_csv(icd: DataFrame, path: str) -> None:
    """The canonical headered CSV (code, description, category), no index.

    Leading and trailing spaces are written as they are (Spark's CSV writer
    would trim them by default)."""
    (icd.select("code", "description", "category").write.mode("overwrite")
        .option("header", True).options(**QUOTING, **KEEP_BLANKS).csv(path))


def read_icd_canonical(spark: SparkSession, path: str) -> DataFrame:
    """Read back the canonical file written by :func:`write_icd_csv`."""
    return (spark.read.option("header", True).option("enforceSchema", False).options(**QUOTING)
            .schema("code string, description string, category string")
            .csv(path))
