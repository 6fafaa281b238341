"""From raw documents to packed token sequences, in five stages.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from abundix.llm import exact_dedup, jaccard, mixing, packing, text_conf, toxicity
from abundix.llm.queries import tokenizer_path
from abundix.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; learned from labels that are not held out."""
    labels = text_conf(spark).read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.where(toxicity.learnable(F.col("doc_id"), 3, 1)).select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, labels)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    text_conf(spark)
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at a similarity of 0.8 the one with the smallest id."""
    text_conf(spark)
    return jaccard.drop_near_copies(docs, width=5, num=8, den=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask for; a repeated document is a repeated row."""
    text_conf(spark)
    return mixing.mixed_documents(docs, F.array("source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    text_conf(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack),
]

#: SQL can express neither the trained stage nor the flow and the dynamic programming.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
