"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.llm import (
    byte_bpe, cover_tree, language_id, merkle, mixing, pitman_yor, quality_rules, rans,
    sharding, simhash, tool_calls, turn_repair, warc,
)
from fabpulse.llm.scratch import scratch_path
from fabpulse.llm.shipping import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules).select(
        "doc_id", *(f"statistics.{name}" for name in quality_rules.COUNTS[:5]),
        "base_failed", "kept", "rule")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs)
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out().alias("held_out"), "language.*")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_path(spark, "archives")
    # Pages have no capture time of their own: their ids stand in for seconds.
    warc.write_archives(pages, path, date=F.timestamp_seconds(1_704_067_200 + F.col("page_id")))
    return warc.capture_histories(spark, path)


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return tool_calls.link(*tool_calls.conversation_calls(turns), tool_calls.SCHEMAS)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cover_tree.integer_vectors(_table(spark, sf_dir, "embeddings"))
    return cover_tree.top_k(vectors, F.col("vec_id") % 100 == 0)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.with_tokens(docs, ranks, public_tokenizers.PATTERN))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(mixing.countable(_table(spark, sf_dir, "documents"))).drop("mark")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op10_rans_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        definition = file.read()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-store")
    rans.write_store(docs, path, definition, end_id=2, added_tokens=True)
    return rans.read_store(spark, path, with_ids=False)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit_documents(_table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_corpus(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_quality_rules, op2_language_id, op3_simhash_dedup, op4_warc, op5_tool_calls, op6_exact_top_k,
        op7_byte_bpe, op8_mixing, op9_sharding, op10_rans_store, op11_turn_repair,
        op12_merkle_manifest, op13_lm_scoring,
    )
}

ORACLES: dict[str, str] = {
    "op5_tool_calls": tool_calls.ORACLE,
    "op6_exact_top_k": cover_tree.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op11_turn_repair": turn_repair.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
