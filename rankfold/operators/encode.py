"""Encoders and pair scorers.

Built-in, model-free and deterministic:
  * ``hash_cells`` / ``hash_vectors``: signed feature hashing of the index terms,
    L2-normalised, summed from an index's postings (or a query set's terms) in
    the shards they lie in: no text is tokenised again and nothing leaves the JVM.
  * ``hash_embed``: the same vector from a text column alone.
    md5 of each term is computed JVM-side; one NumPy bincount per row turns
    the hashes into a dense vector (Arrow-batched pandas UDF).
  * ``token_overlap``: Jaccard similarity of the distinct terms of query and
    text, a pure JVM expression.
User models plug in through ``encode_with`` / ``score_pairs_with``: a
picklable zero-argument factory handed to ``predict_batch_udf``, loaded once
per Python worker and fed fixed-size batches.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankfold.functions.text import tokenize

HASH_DIM = 64


def term_hashes(text) -> Column:
    """ARRAY<BIGINT>: first 15 hex digits of md5(term) for each index term."""
    return F.transform(tokenize(text), lambda t: F.conv(F.substring(F.md5(t), 1, 15), 16, 10).cast("long"))


def _hash_vector_udf(dim: int):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def hash_vectors(hs: pd.Series) -> pd.Series:
        # one bincount for the whole Arrow batch: cell = row * dim + h mod dim
        arrays = [np.asarray(h if h is not None else [], dtype=np.int64) for h in hs]
        lens = np.fromiter((len(a) for a in arrays), dtype=np.int64, count=len(arrays))
        flat = np.concatenate(arrays) if len(arrays) else np.zeros(0, dtype=np.int64)
        rows = np.repeat(np.arange(len(arrays), dtype=np.int64), lens)
        sign = 1.0 - 2.0 * ((flat // dim) % 2)
        m = np.bincount(rows * dim + flat % dim, weights=sign, minlength=len(arrays) * dim)
        m = m.astype(np.float64).reshape(len(arrays), dim)
        norms = np.sqrt((m * m).sum(axis=1))
        m = np.divide(m, norms[:, None], out=m.copy(), where=norms[:, None] > 0)
        return pd.Series(list(m))

    return hash_vectors


def hash_embed(text, dim: int = HASH_DIM) -> Column:
    """Dense ARRAY<DOUBLE> of length ``dim``; all-zero when the text has no term."""
    return _hash_vector_udf(dim)(term_hashes(text))


def hash_embed_cells(df: DataFrame, id_col: str, text_col: str, dim: int = HASH_DIM) -> DataFrame:
    """Sparse form of ``hash_embed``: (id, dim, value) for the non-zero cells."""
    v = df.select(F.col(id_col), hash_embed(text_col, dim).alias("v"))
    return (v.select(id_col, F.posexplode("v").alias("dim", "value"))
            .where(F.col("value") != 0.0)
            .select(id_col, F.col("dim").cast("int").alias("dim"), F.round("value", 9).alias("value")))


def _cell_lists(postings: DataFrame, key: str, weight: str, dim: int) -> DataFrame:
    """key, cells (the non-zero cells as (dim, v) structs), norm."""
    h = F.conv(F.substring(F.md5("term"), 1, 15), 16, 10).cast("long")
    sign = F.lit(1) - F.lit(2) * (F.expr(f"h div {dim}") % 2)  # whole numbers: h has 60 bits
    x = postings.select(F.col(key), F.col(weight).alias("n"), h.alias("h"))
    x = x.groupBy(key, (F.col("h") % dim).cast("int").alias("dim")).agg(F.sum(sign * F.col("n")).cast("double").alias("v")).where("v <> 0")
    return x.groupBy(key).agg(F.collect_list(F.struct("dim", "v")).alias("cells"), F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))


def hash_cells(postings: DataFrame, key: str = "doc_id", weight: str = "tf", dim: int = HASH_DIM) -> DataFrame:
    """key, dim, value: the non-zero cells of the hash vectors of (key, term, weight) rows."""
    x = _cell_lists(postings, key, weight, dim).select(key, "norm", F.explode("cells").alias("c"))
    return x.select(key, F.col("c.dim").alias("dim"), F.round(F.col("c.v") / F.col("norm"), 9).alias("value"))


def hash_vectors(postings: DataFrame, ids: DataFrame, key: str = "doc_id", weight: str = "tf", dim: int = HASH_DIM,
                 out: str = "embedding") -> DataFrame:
    """key, ``out`` (dense ARRAY<DOUBLE>) for every row of ``ids``: all-zero where no term is."""
    cells = F.map_from_entries("cells")
    x = _cell_lists(postings, key, weight, dim).select(F.col(key), cells.alias("cells"), "norm")
    x = ids.select(key).join(x, key, "left")
    value = lambda i: F.coalesce(F.try_element_at("cells", i) / F.col("norm"), F.lit(0.0))
    return x.select(key, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value).alias(out))


def encode_with(df: DataFrame, text_col: str, make_predict_fn: Callable, dim: int,
                out: str = "embedding", batch_size: int = 64) -> DataFrame:
    """I3/I4 with a user encoder: ``make_predict_fn()`` returns f(np.ndarray[str]) -> (n, dim)."""
    from pyspark.ml.functions import predict_batch_udf

    enc = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=None)
    return df.withColumn(out, enc(F.col(text_col)))


def token_overlap(query, text) -> Column:
    """J1 built-in scorer: |terms(q) & terms(t)| / |terms(q) | terms(t)| (0 when both empty)."""
    qt = F.array_distinct(tokenize(query))
    dt = F.array_distinct(tokenize(text))
    inter = F.size(F.array_intersect(qt, dt))
    union = F.size(F.array_union(qt, dt))
    return F.when(union > 0, inter.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


def score_pairs_with(df: DataFrame, make_predict_fn: Callable, query_col: str = "query",
                     text_col: str = "text", out: str = "rerank", batch_size: int = 32) -> DataFrame:
    """J1 with a user pair model: f(queries, texts) -> scores or (n, 2) logits.

    Two-logit outputs are turned into P(relevant) with a softmax on class 1.
    Pass two distinct columns (``predict_batch_udf`` rejects one column twice).
    """
    from pyspark.ml.functions import predict_batch_udf

    def factory():
        fn = make_predict_fn()

        def predict(q: np.ndarray, t: np.ndarray) -> np.ndarray:
            s = np.asarray(fn(q, t), dtype=np.float64)
            if s.ndim == 2 and s.shape[1] == 2:
                return 1.0 / (1.0 + np.exp(s[:, 0] - s[:, 1]))
            return s.reshape(-1)

        return predict

    scorer = predict_batch_udf(factory, return_type=T.DoubleType(), batch_size=batch_size)
    return df.withColumn(out, scorer(F.col(query_col), F.col(text_col)))
