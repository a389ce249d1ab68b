"""Registered queries of the corpus operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.llm.chat import CHAT_SQL, formatted_and_read
from urbanflux.llm.common import table
from urbanflux.llm.divergence import RULES_SQL, quality_rules
from urbanflux.llm.hard_negatives import HARD_SQL, hard_negatives
from urbanflux.llm.licenses import LICENSE_SQL, license_matches
from urbanflux.llm.mixing import MIX_SQL, mix_plan
from urbanflux.llm.pieces import checked, encode_documents
from urbanflux.llm.quality import score_quality
from urbanflux.llm.sharding import shard_documents
from urbanflux.llm.simhash import near_duplicates
from urbanflux.llm.token_files import read_token_files, token_folder, write_token_files
from urbanflux.llm.topk import TOP_K_SQL, top_k
from urbanflux.llm.toxicity import score_toxicity
from urbanflux.llm.whitening import whiten

#: Public vocabularies, where their package has them.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(encode_documents(table(spark, sf_dir, "documents"), PIECES), PIECES)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE, token_folder(spark))
    return read_token_files(files)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("character_distance", "word_distance")


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts are made of control strings."""
    kind = "conv_id long, turn long, role string, text string"
    controls = "<|im_end|><|im_start|>assistant ok"
    planted = spark.createDataFrame([(-1, 0, "user", controls), (-1, 1, "assistant", controls)], kind)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return formatted_and_read(turns.unionByName(planted), BYTE_BPE)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation as long; null where it needs more than 64 bits."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_sharding": op3_sharding,
    "op4_licenses": op4_licenses,
    "op5_top_k": op5_top_k,
    "op6_pieces": op6_pieces,
    "op7_simhash": op7_simhash,
    "op8_token_files": op8_token_files,
    "op9_quality": op9_quality,
    "op10_quality_rules": op10_quality_rules,
    "op11_chat": op11_chat,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {
    "op2_mixing": MIX_SQL, "op4_licenses": LICENSE_SQL, "op5_top_k": TOP_K_SQL, "op10_quality_rules": RULES_SQL,
    "op11_chat": CHAT_SQL, "op12_hard_negatives": HARD_SQL,
}
