"""The documents pipeline: toxic texts out, copies and near copies out, sources
mixed, texts encoded. Each stage reads what the one before it wrote."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import exact_dedup, mixing, ngram_join, toxicity, word_bpe
from tillwright.llm.shared import documents, staged


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go. The classifier learns from the documents that have
    labels, whatever rows ``docs`` holds."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.keep_one(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts joined by links one row stays."""
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; rows of smaller sources are repeated up to the limit."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of every row of the mixture."""
    return word_bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("word_bpe", encoding_stage),
]

#: Learnt scores and byte pair encodings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
