"""One query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridweave.llm.centroids import clusters
from gridweave.llm.common import table
from gridweave.llm.decontaminate import contamination
from gridweave.llm.html_extract import main_texts
from gridweave.llm.language import language
from gridweave.llm.ngram_jaccard import jaccard_components
from gridweave.llm.pivot_topk import top_k
from gridweave.llm.posting_lists import neighbours
from gridweave.llm.quality import quality
from gridweave.llm.sentencepiece import encode
from gridweave.llm.spelling import variants
from gridweave.llm.toxicity import toxicity
from gridweave.llm.url_templates import url_verdicts
from gridweave.llm.warc import archive_digest


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language(table(spark, sf_dir, "documents"))


def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_digest(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def op13_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_pivot_topk": op2_pivot_topk,
    "op3_language": op3_language,
    "op4_url_templates": op4_url_templates,
    "op5_decontamination": op5_decontamination,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_html_extract": op7_html_extract,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_spelling": op11_spelling,
    "op12_centroids": op12_centroids,
    "op13_posting_lists": op13_posting_lists,
}
