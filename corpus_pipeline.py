"""Pipeline over documents: each stage's rows are stored as Parquet and reread as the next one's input.

language ID -> toxicity -> n-gram Jaccard join -> benchmark decontamination -> packing. The first four
return the columns of documents and fewer rows; packing returns pieces of token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom import staging
from ratingloom.llm import decontamination, jaccard_join, language_id, packing, toxicity
from ratingloom.llm.queries import tokenizer_path, toxicity_model


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts that are null or have no letter go."""
    learned = docs.where(~language_id.held_out(F.col("doc_id"), 4, 2))
    model = language_id.fit(learned, "text", "lang")
    return language_id.identify(docs, "text", model).where(language_id.accepted()).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely not toxic."""
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, "text", model).where(~toxicity.toxic()).select(*docs.columns)


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return jaccard_join.keep_one(docs, "doc_id", "text")


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a noticeable share of benchmark passages."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, "text", benchmark, "item_id", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left as token sequences."""
    return packing.pack_texts(docs, "doc_id", "text", tokenizer_path(), end_id=1)


STAGES = [
    ("language ID", known_language),
    ("toxicity", not_toxic),
    ("n-gram Jaccard join", no_copies),
    ("benchmark decontamination", not_in_benchmark),
    ("packing", packed),
]

#: Learned models, MinHash and a tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
