"""From raw documents to packed training sequences; every stage is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivo.llm import langid_gru, mixing, packing, partenum, pii_crf
from arrivo.session import materialize

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a known language go (null texts, texts without a letter, blind guesses)."""
    return langid_gru.keep_known(docs, langid_gru.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each component stays, the one with the smallest id."""
    return partenum.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked by its kind; all rows stay."""
    return pii_crf.mask(docs, pii_crf.fit(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents are left out or repeated as the schedule takes them."""
    return mixing.mixed_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of power-of-two lengths, by the digest of their ids."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("sequences", sequences),
]

#: The trained stages are beyond SQL; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
