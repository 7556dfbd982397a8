"""The corpus pipeline: documents -> quality rules -> quality classifier -> line dedup -> near dedup
-> packed sequences. Every stage works on what the one before it kept, written and read again."""

from pyspark.sql import DataFrame, SparkSession

from runlens.llm import line_dedup, near_dedup, quality_classifier, quality_rules, queries
from runlens.sources import staging


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    return quality_classifier.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the multi-line passages that another document, or an earlier place, holds."""
    return line_dedup.filter_documents(docs, staging.Scope(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates. Line dedup has cut out of near copies what they share, so
    that two are told by their texts as they came as well as by what is left of them."""
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_dedup.filter_documents(docs, line_dedup.texts_before(docs, whole, staging.Scope(spark)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents, packed into sequences."""
    return queries.packed(docs, staging.Scope(spark))


STAGES = [
    ("quality_rules", rules),
    ("quality_classifier", classifier),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("best_fit_packing", packing),
]

#: The fitted classifier cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.stage(stage(spark, docs, sf_dir), name)
    return docs
