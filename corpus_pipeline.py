"""The corpus pipeline: documents through five stages, each calling one operator of `fabpulse.llm`.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the
last return the columns of documents; the last returns what the encoding query returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fabpulse.llm import byte_bpe, language_id, mixing, quality_rules, simhash
from fabpulse.llm.scratch import scratch_path
from fabpulse.llm.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    model = language_id.fit(docs)
    judged = language_id.identify(docs.select(*COLUMNS), model, into="__language")
    return judged.where("not __language.rejected").select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned rules reject go."""
    rules = quality_rules.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(docs.select(*COLUMNS), rules).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest doc_id."""
    return simhash.keep_one(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mix_documents(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every whole text encoded, and decoded again."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(byte_bpe.with_tokens(
        docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("quality_rules", quality),
    ("simhash_dedup", near_dedup),
    ("mixing", mixed),
    ("byte_bpe", tokens),
]

# Models are learned and tokens merged by rank, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each stage's rows written and read again for the next."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
ORACLES: dict[str, str] = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
