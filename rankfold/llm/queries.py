"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankfold.llm import (conversation_repair, hash_tree, html_text, jaccard_join, mih, mixing, quality_classifier, quality_rules, quotes, reversed_search,
                          secrets, segment_sampling, token_counts)
from rankfold.llm.common import table

#: Segmentations drawn of each document: enough that sets opened by the search are opened again.
SEGMENTATIONS = 8


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op1(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op2(table(spark, sf_dir, "pages"))


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(table(spark, sf_dir, "conversations"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op4(table(spark, sf_dir, "documents"))


def op5_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_sampling.sample_segmentations(table(spark, sf_dir, "documents"), k=SEGMENTATIONS)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.op6(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op7(table(spark, sf_dir, "documents"))


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.op8(table(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op10(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.op11(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.op12(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.op13(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_html_extraction, op3_quotation_linking, op4_ngram_jaccard_join, op5_sentencepiece_sampling,
                                   op6_quality_classifier, op7_secret_scan, op8_multi_index_hashing, op9_token_counts, op10_temperature_mixing,
                                   op11_sharding, op12_ranked_search, op13_conversation_repair)}

ORACLE_SQL = {"op1_quality_rules": quality_rules.ORACLE, "op3_quotation_linking": quotes.ORACLE,
              "op4_ngram_jaccard_join": jaccard_join.ORACLE,
              "op10_temperature_mixing": mixing.ORACLE, "op11_sharding": hash_tree.ORACLE, "op12_ranked_search": reversed_search.ORACLE,
              "op13_conversation_repair": conversation_repair.ORACLE}
