"""The registered queries of this package and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm import alignment, ann, bpe_codec, chat, hard_negatives, mixing, near_dup, packing, sharding, suffix_dedup, token_counts, topk, toxicity
from topicloom.llm.common import read
from topicloom.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, build: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = build
    if sql is not None:
        ORACLES[name] = sql


def op1_threshold_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k_search(read(spark, folder, "embeddings"))


def op5_collision_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(read(spark, folder, "embeddings"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"), 16)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_add("op4_suffix_dedup", op4_suffix_dedup)


def op7_lexical_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read(spark, folder, "documents"))


_add("op7_lexical_packing", op7_lexical_packing)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"))


_add("op8_token_counts", op8_token_counts)


def op2_chat_tree(spark: SparkSession, folder: str) -> DataFrame:
    return chat.read_back(*chat.format_conversations(chat.with_probe(read(spark, folder, "conversations"))))


_add("op2_chat_tree", op2_chat_tree, chat.CHAT_SQL)


def op10_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


_add("op10_order_minhash", op10_order_minhash)


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, folder, "documents").select("doc_id", "text"), read(spark, folder, "labels")).drop("text")


_add("op9_toxicity", op9_toxicity)
_add("op1_threshold_top_k", op1_threshold_top_k, topk.TOPK_SQL)
_add("op5_collision_neighbours", op5_collision_neighbours)
_add("op3_mix_sources", op3_mix_sources, mixing.MIX_SQL)
_add("op6_jump_shards", op6_jump_shards, sharding.SHARD_SQL)


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe_codec.encode_texts(read(spark, folder, "documents").select("doc_id", "text")).drop("text")
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    ids = ids.withColumns({"n_tokens": F.size("ids").cast("bigint"), "ids_sha256": digest})
    return bpe_codec.decode_ids(ids).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


_add("op12_byte_bpe", op12_byte_bpe)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    grouped = alignment.group_tokens(read(spark, folder, "documents").select("doc_id", "text")).drop("text")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    kept = materialize(grouped.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.score_links(kept)


_add("op11_token_alignment", op11_token_alignment)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(read(spark, folder, "embeddings").withColumn("label", moved)).drop("positive_rank")


_add("op13_hard_negatives", op13_hard_negatives, hard_negatives.MINING_SQL)
