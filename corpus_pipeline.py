"""The corpus pipeline: stages over `documents`, each working on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridweave.llm import decontaminate, ngram_jaccard, quality, sentencepiece, toxicity
from gridweave.llm.common import table, written


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold, by a model of the labelled ones."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained scorer takes for good."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id."""
    return ngram_jaccard.keep_one(docs)


def free_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return sentencepiece.encode(docs)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("quality classifier", of_good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", free_of_benchmark),
    ("SentencePiece encoding and decoding", as_pieces),
]

#: fitted classifiers and piece search have no counterpart in SQL; tests hold every stage against
#: a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
