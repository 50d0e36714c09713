"""A training-data pipeline over ``documents``: one operator of ``gridspark.llm`` a stage.

Each stage takes all that its predecessor kept and returns the columns of
documents, the last one the token files' rows (doc_id, start, n_tokens,
ids_crc32).  Extra columns of documents pass through; documents with null ids,
null texts or repeated rows are treated as the operators' docstrings say.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import decontam, mixing, quality, queries, simhash
from gridspark.llm.common import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the n-gram model of trusted text accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judge(docs, labels, "doc_id", "lang", "text")
    return quality.keep_accepted(docs, judged, "doc_id", "text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, that of the smallest id."""
    found = simhash.near_duplicates(docs, "doc_id", "text", shingle=4, max_bits=4)
    return simhash.keep_one(docs, found, "doc_id", "text")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.drop_contaminated(docs, decontam.build_index(items, "item_id", "text"), "text")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at target weights: a document stands in it once a copy taken."""
    mix = mixing.plan_mix(docs, "doc_id", "text", "source")
    return mixing.mixed_rows(docs, mix, "doc_id", "text", "source")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, written and read back."""
    return queries.tokens_of(spark, docs)


#: (name, function of (spark, docs, sf_dir)), in the order they run.
STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: SQL for the rows of run(); None: the model, the draws and the tokenizer are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
