"""Compare a registered query with its DuckDB SQL; small frames."""

from collections import Counter

import duckdb

from carelake.llm.oracle import oracle_sql
from carelake.llm.queries import queries

TABLES = ["documents", "embeddings", "conversations", "benchmark", "labels", "pages"]


def compare(spark, name, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = queries()[name](spark, sf_dir)
    want = con.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    names = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean"}
    assert {c: names[str(t)] for c, t in zip(want.columns, want.types)} == dict(got.dtypes)
    rows = Counter(tuple(r) for r in got.select(*sorted(got.columns)).collect())
    order = [want.columns.index(c) for c in sorted(want.columns)]
    expected = Counter(tuple(r[i] for i in order) for r in want.fetchall())
    assert rows == expected, (list((rows - expected).items())[:5], list((expected - rows).items())[:5])
    return rows


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=DOC_SCHEMA):
    """Rows of (doc_id, text[, lang, source])."""
    full = [(*r, *[None] * (5 - len(r))) for r in rows]
    return spark.createDataFrame(full, schema)


def write_tables(spark, folder, **frames):
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
