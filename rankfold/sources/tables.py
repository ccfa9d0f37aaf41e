"""A1: load the input tables and map them onto the engine's schemas.

Text corpus = ``documents``; text queries = ``benchmark``; vector corpus and
vector queries = ``embeddings`` (every vector is also a query; the vector
itself is excluded from its own answers).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F



def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id LONG, text STRING."""
    return load_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id LONG, query STRING (the rename text -> query of the reference loader)."""
    return load_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("long").alias("query_id"), F.col("text").alias("query"))


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id LONG, embedding ARRAY<FLOAT>, label INT."""
    return load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("doc_id"), "embedding", "label")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id LONG, embedding ARRAY<FLOAT>, label INT."""
    return load_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("long").alias("query_id"), "embedding", "label")

