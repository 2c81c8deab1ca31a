"""Corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.mixing import mixed_documents
from gridloom.llm.near import one_of_near
from gridloom.llm.packing import pack_documents
from gridloom.llm.pii import pseudonymized
from gridloom.llm.quality import kept_documents
from gridloom.llm.shared import documents, stage, workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't outliers of their language and source."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash masks propose and four fifths of five-word shingles link: the one with the smallest doc_id."""
    return one_of_near(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by pseudonyms; n_chars follows."""
    out = pseudonymized(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), release=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: Packing and the covariance estimates can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    folder = workspace(spark, "pipeline")
    for i, (name, function) in enumerate(STAGES[:-1]):
        docs = stage(function(spark, docs, sf_dir), f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
