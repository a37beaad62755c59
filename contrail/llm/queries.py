"""The operators bound to the given tables: ``queries`` and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (bpe_tree, bpe_trie, chat_render, contamination, hnsw, jump_shards, near_dups, oracles,
                          pfor_ids, toxic_spans, turn_repair, warc_zstd, weak_quality, whitening)
from contrail.llm.common import table, work_folder


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op2_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.shard_documents(table(spark, sf_dir, "documents"))


def op3_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zstd.write_and_read(table(spark, sf_dir, "pages"))


TOXIC_AT = 0.3


def op4_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxic_spans.train_model(docs, table(spark, sf_dir, "labels"))
    return toxic_spans.score_documents(docs, model).select(
        "doc_id", toxic_spans.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"), "spans")


def op5_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.score_quality(table(spark, sf_dir, "documents"))


def op6_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


def op7_pfor_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor_ids.write_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


PROBE_TEXT = "\\### Assistant: </turn> ok"   # a text full of the template's own marks


def op8_chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return chat_render.format_and_read(turns.unionByName(probe), work_folder(spark, "chat"))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.bpe_digests(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.find_contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.damage_and_repair(table(spark, sf_dir, "conversations"))


def op13_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.trie_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_duplicates, op2_jump_shards, op3_warc_dictionary, op4_toxic_spans,
                                  op5_weak_quality, op6_hnsw,
                                  op7_pfor_token_ids, op8_chat_render, op9_bpe_tree, op10_benchmark_containment,
                                  op11_whitening, op12_turn_repair, op13_bpe_trie)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
