"""From raw documents to packed training sequences, in five stages.

1. quality rules: rows without a word, rows that fail the rule of repeated words or
   the adaptive fences go (short texts stay);
2. language ID: rows in no language go;
3. SimHash near-dedup: one row of each group of near copies stays (4-word
   shingles, at most 4 bits apart);
4. substring dedup: words in passages of 35 words that are found elsewhere go;
5. packing: token pieces in sequences of 1024.

A stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of documents. What a stage returns is written as
Parquet and read again for the next one; ``run`` then drops the stage's scratch
tables, which nothing reads any more.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from carelake.llm import common, language_id, packing, quality_rules, simhash_dedup, substring_dedup
from carelake.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
LEAST_WORDS = 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs, min_words=LEAST_WORDS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.filter_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.strip_documents(docs, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, TOKENIZER, PATTERN, carry=["doc_id"])


STAGES = [("quality rules", quality), ("language ID", language), ("near duplicates", near_duplicates),
          ("substring dedup", repeated_passages), ("packing", pack)]

# Language ID and packing have no SQL form; tests/llm/test_pipeline.py checks
# every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the pieces of the last."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        with common.collect_written() as written:
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        common.drop_tables(spark, written)
    return STAGES[-1][1](spark, docs, sf_dir)
