"""The registered queries of this package: (spark, sf_dir) -> DataFrame, each
over the whole of its table, with the operators' production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import ann_graph, chat_format, conversation_trie, language_id, license_scan, merkle_manifest, packing, piece_codec, quality_classifier, quality_rules, sharding, simhash_dedup, substring_dedup
from carelake.llm.common import ROW, materialise, table


SHARDS = 40


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign_shards(docs, SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return done.select(F.col(f"{ROW}.doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The conversation that imitates marks: its texts are control strings.
    imitation = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                      "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(imitation)
    return chat_format.digest_conversations(chat_format.format_conversations(turns))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op1_ann_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_graph.nearest(table(spark, sf_dir, "embeddings"), wanted=5, query=F.col("id") % 50 == 0)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.PATTERN, carry=["doc_id"])


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "license", "score", F.array_join("licenses", ",").alias("licenses"), "n_matches")


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_codec.encode(table(spark, sf_dir, "documents"), model, carry=["doc_id"])
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    decoded = piece_codec.decode(encoded.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": digest}), model,
                                 carry=["doc_id", "n_tokens", "ids_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language_id.collect_profiles(language_id.train_profiles(docs.where(~language_id.held_out())))
    return language_id.predict_language(docs.withColumn("held_out", language_id.held_out()), known,
                                        carry=["doc_id", "held_out"])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    head, text = ["doc_id", "source", "lang", "n_chars"], F.col("text")
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & text.contains("\n")
    leaf = merkle_manifest.leaf([*head, text])
    shown = F.when(tampered, merkle_manifest.leaf([*head, F.replace(text, F.lit("\n"), F.lit(""))])).otherwise(leaf)
    rows = materialise(table(spark, sf_dir, "documents").select("doc_id", "source", leaf.alias("leaf"), shown.alias("shown")), "merkle-input")
    made = merkle_manifest.build_manifest(rows, "source", ["doc_id"], "leaf")
    root = F.lit(made.root.hex() if made.root else None).cast("string")
    proved = merkle_manifest.prove(made, "shown", ["doc_id", "digest"])
    return proved.select("doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", root.alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == root).alias("verified"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = quality_classifier.held_out()
    measured = quality_classifier.measure_documents(table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id"), "held_out": held})
    scored = quality_classifier.score_documents(measured, quality_classifier.train(measured, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, sizes = conversation_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    rebuilt = conversation_trie.share_heads(turns, sizes, conv - conv % 100, F.crc32(conv.cast("string")) % 6, most=5)
    return conversation_trie.build_trie(*rebuilt)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ann_graph, op2_packing, op3_license_scan, op4_simhash_dedup, op5_sentencepiece, op6_language_id, op7_sharding, op8_substring_dedup, op9_chat_format,
                                    op10_quality_rules, op11_merkle_manifest, op12_quality_classifier, op13_conversation_trie)}
