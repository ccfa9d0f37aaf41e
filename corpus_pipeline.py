"""Corpus pipeline: quality classifier, near duplicates, secrets, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankfold.llm import jaccard_join, mixing, quality_classifier, secrets, segment_sampling
from rankfold.llm.common import free_executors, prepare, table, written


def begin(spark: SparkSession) -> None:
    """What every stage starts with: the executors let go of what the stage before has left."""
    prepare(spark)
    free_executors(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    begin(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard 0.8 or more) stays."""
    begin(spark)
    return jaccard_join.drop_near_duplicates(docs, percent=80, width=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts."""
    begin(spark)
    return secrets.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated as their source's weight says."""
    begin(spark)
    return mixing.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, with their ids."""
    begin(spark)
    return segment_sampling.sample_segmentations(docs, with_ids=True)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("mixing", source_mixing),
          ("encoding", encoding)]

#: The classifier, the tagger and the sampler can't be written in SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to the documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
