"""A corpus through five stages of the text operators, each written as Parquet and read again.

Every stage takes (spark, docs, folder) and returns rows with the columns of ``documents``; the last one adds ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shoptrail.llm import bpe, decontaminate, ngram_join, suffix_dedup, toxicity
from shoptrail.llm.queries import tokenizer
from shoptrail.session import materialize

# SQL expresses neither the fitted grammar nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits on the labelled rows of ``docs`` and drops what is scored 0.5 or more."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each class of alike documents."""
    return ngram_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what an earlier document has too, in strings of 50 bytes; documents stay, maybe with an empty text."""
    return suffix_dedup.remove_repeats(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids to every document."""
    return bpe.encode(docs, tokenizer("word_bpe_49k.json"), *docs.columns).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaked),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
