"""From raw documents to packed training sequences.

STAGES in order: quality rules drop bad documents, near duplicates are reduced to the first of each group,
documents with benchmark passages go, and what stays is packed. Each stage reads all that the one before
kept, as written to Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from visloom.llm import decontaminate, neardup, quality, shared
from visloom.llm.queries import packed_pieces


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, fitted on the labelled ones among them.

    Null and empty texts fail; repeated rows are judged alike; an empty table gives none; other columns stay as they are.
    """
    shared.small_batches(spark)
    return quality.good_documents(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates (five words, similarity 0.8).

    Null and empty texts are like no other and stay, as do rows without an id; of rows that repeat an id the one whose
    text sorts first stays; other columns stay as they are.
    """
    shared.small_batches(spark)
    return neardup.one_of_each(docs, k=5, percent=80)


def untested(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.

    Null and empty texts hold none and stay; repeated rows go or stay alike; other columns stay as they are.
    """
    shared.small_batches(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids and their places in sequences.

    Null and empty texts are their end id alone; repeated rows are packed each; null ids stay null.
    """
    shared.small_batches(spark)
    return packed_pieces(docs)


STAGES = [("quality", good), ("near_duplicates", distinct), ("decontamination", untested), ("packing", packed)]

#: Neither boosted trees nor column generation can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared.new_dir(spark, "pipeline")
    for name, stage in STAGES:
        docs = shared.store(stage(spark, docs, sf_dir), folder, name)
    return docs
