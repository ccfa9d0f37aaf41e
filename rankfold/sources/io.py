"""Sinks and readers.

Answer sets are exported with ``relevant`` as 'yes'/'no' (the reference's
text form); internally it stays BOOLEAN.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankfold.functions.text import query_slug


def _export_form(df: DataFrame) -> DataFrame:
    if "relevant" in df.columns and dict(df.dtypes)["relevant"] == "boolean":
        df = df.withColumn("relevant", F.when(F.col("relevant"), "yes").otherwise("no"))
    return df


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A2/A5: tab-separated with header, backslash escape (texts hold tabs/newlines/quotes)."""
    (_export_form(df).write.mode(mode).option("sep", "\t").option("escape", "\\")
     .option("header", True).csv(path))


def read_tsv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Reads :func:`write_tsv` output back; ``multiLine`` because texts contain newlines."""
    r = (spark.read.option("sep", "\t").option("escape", "\\").option("header", True)
         .option("multiLine", True))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A3: JSON lines."""
    _export_form(df).write.mode(mode).json(path)


def read_jsonl(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite") -> dict[str, str]:
    """A4: one JSON-lines folder per named table (full, train, test, pair splits)."""
    out = {}
    for name, df in tables.items():
        out[name] = os.path.join(root, name)
        write_jsonl(df, out[name], mode)
    return out


def with_query_slug(df: DataFrame, query_col: str = "query") -> DataFrame:
    """Folder-safe name from the query text."""
    return df.withColumn("query_slug", query_slug(query_col))


def write_per_query(df: DataFrame, path: str, fmt: str = "json", buckets: int | None = None,
                    mode: str = "overwrite") -> None:
    """One output folder per query (``query_id=<id>``), the slug kept as a column.

    The slug is derived from the whole query text, which can exceed file-name
    limits, so it is stored in the rows rather than in the folder name. For
    very large query sets pass ``buckets`` to partition by a hash bucket of
    query_id instead of one folder per query.
    """
    df = _export_form(df)
    if "query_slug" not in df.columns and "query" in df.columns:
        df = with_query_slug(df)
    if buckets:
        df = df.withColumn("query_bucket", F.pmod(F.xxhash64("query_id"), F.lit(buckets)))
        parts = ["query_bucket"]
    else:
        parts = ["query_id"]
    df.repartition(*parts).write.mode(mode).partitionBy(*parts).format(fmt).save(path)
