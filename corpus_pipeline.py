"""Corpus pipeline: reject toxic and poor documents, keep one of each near-duplicate group, mix sources, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflux.llm.common import table, written_table
from urbanflux.llm.mixing import mix
from urbanflux.llm.near_copies import keep_one_similar
from urbanflux.llm.pieces import checked, encode_documents
from urbanflux.llm.queries import PIECES
from urbanflux.llm.quality import score_quality
from urbanflux.llm.toxicity import score_toxicity


def packed(docs: DataFrame) -> DataFrame:
    """The columns a score reads, and each whole row in one column, whatever the names in it."""
    return docs.select("doc_id", "text", F.struct("*").alias("document"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not predict as toxic.

    Null and empty texts are scored like others (by the bias alone); rows keep all their columns, whatever
    their names, and repeated rows stay. An empty table gives an empty result.
    """
    scored = score_toxicity(packed(docs), table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 0").select("document.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine predicts as good; odd rows as in ``toxicity``."""
    scored = score_quality(packed(docs), table(spark, sf_dir, "labels"))
    return scored.filter("predicted = 1").select("document.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, Jaccard similarity 0.8 or more.

    Null and empty texts are one group; see ``keep_one_similar`` for ties, null and repeated ids.
    """
    return keep_one_similar(docs, width=5, similarity=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it; null texts have no words, null sources are one source."""
    return mix(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, pieces_crc32 and lossless of every row: sampled pieces, written, read and decoded again.

    Null texts count as empty, texts of any length are encoded whole, and repeated or null
    ids are rows like others. Written between the two, encoding and decoding use the same
    workers one after the other.
    """
    encoded = encode_documents(docs.select("doc_id", "text"), PIECES)
    return checked(written_table(encoded, "pieces"), PIECES)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]

#: The classifiers are fitted and the pieces are drawn: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
