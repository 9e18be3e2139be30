"""The pipe-delimited claims file (bronze).

The file is read as text: every column STRING, names from the header line,
no schema inference (it would turn '01' into 1 and cost an extra pass).
Columns are chosen *by name*.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions.columns import iso_date_text
from carelake.schemas import DATE_COLUMNS, RAW_CLAIM_COLUMNS
from carelake.sources.ingest import file_mark
from carelake.sources.sinks import QUOTING

INGEST_ORDER = "_ingest_seq"


class SourceMissing(RuntimeError):
    """Raised when the raw claims file is absent or empty."""


def _reader(spark: SparkSession):
    """All text, names from the header of every file (a file whose header
    differs is refused), quotes doubled inside quoted fields."""
    return (spark.read.option("header", True).option("sep", "|").option("enforceSchema", False).options(**QUOTING))


def read_claims_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    normalize_dates: bool = False,
    ingest_order: bool = True,
) -> DataFrame:
    """Read the raw claims file: every header column as it is, or ``columns``.

    Reading every column refuses lines with too few or too many fields; a
    read of some columns parses only those, so load bronze first.

    ``normalize_dates`` renders CLM_FROM_DT / CLM_THRU_DT as ISO text when they
    parse as yyyy-MM-dd, yyyyMMdd or dd-MMM-yyyy (staging does it by default).

    ``ingest_order`` adds ``_ingest_seq``: (path, split start, position inside
    the split), which sorts rows in file order: files by path, rows of a file as
    they are written. "Keep the first row" operators order by it, because a
    distributed scan does not keep file order by itself; the runs turn it into one
    number first (``ingest.dense_order``).
    """
    raw = _reader(spark).option("mode", "FAILFAST").option("columnPruning", columns is not None).csv(path)
    missing = [c for c in (columns or RAW_CLAIM_COLUMNS) if c not in raw.columns]
    if missing:
        raise SourceMissing(f"claims file lacks columns {missing}")
    exprs = []
    for c in columns or raw.columns:
        exprs.append((iso_date_text(f"`{c}`") if normalize_dates and c in DATE_COLUMNS else F.col(f"`{c}`")).alias(c))
    if ingest_order:
        exprs.append(file_mark().alias(INGEST_ORDER))
    return raw.select(*exprs)


def require_source(spark: SparkSession, path: str, check_empty: bool = True) -> None:
    """S13 gate: fail when the raw file is missing (or has no data rows)."""
    try:
        df = _reader(spark).csv(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise SourceMissing(f"claims source not found: {path}") from exc
    if check_empty and df.isEmpty():
        raise SourceMissing(f"claims source has no rows: {path}")
