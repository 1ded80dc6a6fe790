"""A corpus pipeline: five of the operators of ``histflow.llm``, one behind the other.

Each stage takes what the one before it kept, is written as Parquet, and is read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from histflow.llm import op01_jaccard_join, op02_sentencepiece, op03_decontamination, op08_pii, op10_quality_rules
from histflow.llm.common import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return op10_quality_rules.kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return op01_jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages to speak of."""
    return op03_decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by pseudonyms."""
    changed = op08_pii.pseudonymize(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of ids and decoded text."""
    import public_tokenizers

    return op02_sentencepiece.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("PII", pseudonyms),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# Perplexity, pseudonyms and segmentation are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.lower().replace(' ', '-')}")
    return docs
