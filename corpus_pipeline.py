"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetrank.llm import catalog, decontaminate, ngram_join, packing, pii, quality, tables


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (the smallest doc_id)."""
    return ngram_join.keep_one(docs, n=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    return decontaminate.decontaminate(docs, tables.docs_of(spark, sf_dir, "benchmark"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; ``n_chars`` follows the new text."""
    replaced = pii.replace(docs, catalog.PII_KEY)
    return replaced.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else replaced


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences."""
    return packing.pack_documents(docs, catalog.tokenizer_path(), max_tokens=4096)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("PII", with_surrogates),
    ("best-fit packing", packed),
]

#: The stages train models and align texts, which SQL can't express; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = tables.docs_of(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = tables.stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
