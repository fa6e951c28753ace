"""A corpus pipeline of five operators: quality, exact copies, near copies, mixture, token ids.

run() applies STAGES to documents; every stage works on all that the one before kept. The
first four return the columns of documents, the last the digests of each row's token ids.
Nulls and repeated rows are treated as the operators' own docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestore.llm import byte_bpe, chosen_path, curriculum, exact_dedup, quality_cnn
from lodestore.llm.common import fold_of, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects. It learns from the labelled documents of sf_dir that op4 learns from."""
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    net = quality_cnn.learn(source, labels, fold_of("doc_id", 5) != 0)
    return quality_cnn.keep_good(docs, net)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return chosen_path.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the mixture takes, in training order; a document may stand in it up to three times."""
    return curriculum.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    bpe = byte_bpe.ByteBpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.digests(bpe, docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing to target weights", mixture), ("byte-level BPE", encode)]

#: A network's scores and Jaccard components are beyond SQL; a test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
