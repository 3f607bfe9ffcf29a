"""Corpus pipeline over documents: reject poor text, drop copies and near copies, mix the sources, encode.

STAGES are (name, function) with function(spark, docs, sf_dir) -> DataFrame. Each stage's result is written as Parquet and
read again as the next stage's docs; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import bpe, exact_dedup, mixing, ngram_join, quality
from quillspark.llm.common import stored, tune


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on this stage's documents, finds good."""
    tune(spark)
    return quality.good_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the one with the smallest id."""
    tune(spark)
    return exact_dedup.deduplicated(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document."""
    tune(spark)
    return ngram_join.distinct_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document (byte_bpe_50k), and the digests of ids and decoded bytes."""
    import public_tokenizers

    tune(spark)
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram jaccard join", near_stage),
    ("mixing", mixing_stage),
    ("byte-level bpe", encoding_stage),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents; the stages' results lie in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
