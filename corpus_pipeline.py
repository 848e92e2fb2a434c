"""From raw documents to packed training sequences: the corpus operators in a row."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tremor.llm.base import documents
from tremor.llm.exact_dedup import drop_exact_duplicates
from tremor.llm.mixing import mix, repeat_documents
from tremor.llm.near_dedup import drop_near_duplicates
from tremor.llm.packing import pack_documents
from tremor.llm.toxicity import drop_toxic, train
from tremor.workspace import settled


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the model learns from the labels of folds 1 to 4."""
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest doc_id."""
    return drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of texts that share 0.8 of their five-word shingles, the smallest doc_id."""
    return drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as the mix of sources takes it: not at all, once or twice."""
    return repeat_documents(docs, mix(docs))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

# The model, the balanced rates and the tokenizer have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's result is written and read again, and its scratch tables are deleted."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settled(spark, lambda: stage(spark, docs, sf_dir), name.replace(" ", "-"))  # noqa: B023
    return docs
