"""The corpus pipeline: toxicity, quality, near copies, mixing and packing, each stage over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import mixing, ngram_join, packing, quality, toxicity
from tidemark.llm.common import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that operator 4 predicts toxic go."""
    return toxicity.clean_documents(docs, toxicity.train_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def drop_poor(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that operator 5 doesn't keep go."""
    return quality.good_documents(docs, quality.train_quality(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each of operator 8's classes the document with the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents come as often as operator 2's mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Places of all pieces of the documents in operator 10's sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The stages rest on fitted models, hashed orders and token ids, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
