"""From raw documents to packed training sequences: five stages, each one operator.

A stage gets the documents its predecessor kept, as a table reread from Parquet, and returns
them with its decisions applied; the last returns the bins. `run` writes what a stage returns
under the session's shared folder, so a stage neither computes its predecessors again nor
depends on executors that ran them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, ngram_join, packing, quality_classifier, quality_rules
from tidemark.llm.queries import BIN_BYTES, quality_model
from tidemark.session import scratch_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.keep_passing(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality scores 0.5 or more.

    The model learns from labelled rows of the raw documents outside the held-out fold: the
    rules before have taken away most of the bad ones.
    """
    return quality_classifier.keep_good(docs, quality_model(spark, sf_dir))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller id holds; n_chars follows the text."""
    shorter = line_dedup.drop_repeated_lines(docs).drop("line counts")
    return shorter.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id.

    A document without an id is in no group and stays.
    """
    groups = ngram_join.ngram_classes(docs)
    copies = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def best_fit_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their bins."""
    return packing.best_fit(docs, BIN_BYTES)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("best-fit packing", best_fit_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows."""
    root = scratch_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


# Compression, a trained model and greedy packing cannot be said in SQL; tests hold the stages
# against brute force instead.
ORACLE_SQL = None
