"""Ranks and top-k per query; J3: reciprocal rank fusion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from rankfold.functions.scoring import rrf_term
from rankfold.schemas import require_columns


def rank_within(df: DataFrame, score: str = "score", descending: bool = True,
                key: str = "query_id", tie: str = "doc_id", out: str = "rnk") -> DataFrame:
    """Adds a 1-based INT rank per ``key``: score order, ties by ``tie`` ascending."""
    order = F.col(score).desc() if descending else F.col(score).asc()
    w = Window.partitionBy(key).orderBy(order, F.col(tie).asc())
    return df.withColumn(out, F.row_number().over(w).cast("int"))


def top_k(df: DataFrame, k: int, score: str = "score", descending: bool = True,
          key: str = "query_id", tie: str = "doc_id", out: str = "rnk") -> DataFrame:
    """Top-k rows per key. The filter sits right above the window so Catalyst
    plans a partial+final WindowGroupLimit (k rows per key leave each task)."""
    return rank_within(df, score, descending, key, tie, out).where(F.col(out) <= k)


def rrf_two(run1: DataFrame, run2: DataFrame, k: int = 60, rank_base: int = 0,
            missing: str = "union_size", digits: int = 9) -> DataFrame:
    """Fuse two ranked lists per query (full outer join on query_id, doc_id).

    rank1/rank2 are ``rnk - 1 + rank_base``; a document missing from a list
    gets rank N = size of the per-query union (``missing='union_size'``) or
    contributes nothing (``missing='drop'``). Output: query_id, doc_id,
    rank1, rank2 (DOUBLE), rerank (rounded), rnk.
    """
    for r in (run1, run2):
        require_columns(r, "query_id", "doc_id", "rnk", what="ranked list")
    a = run1.select("query_id", "doc_id", (F.col("rnk") - 1 + rank_base).cast("double").alias("rank1"))
    b = run2.select("query_id", "doc_id", (F.col("rnk") - 1 + rank_base).cast("double").alias("rank2"))
    both = a.join(b, ["query_id", "doc_id"], "full_outer")
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id")).cast("double")
    both = both.withColumn("n_union", n)
    if missing == "union_size":
        both = (both.withColumn("rank1", F.coalesce("rank1", "n_union"))
                    .withColumn("rank2", F.coalesce("rank2", "n_union")))
        score = rrf_term(F.col("rank1"), k) + rrf_term(F.col("rank2"), k)
    elif missing == "drop":
        score = (F.coalesce(rrf_term(F.col("rank1"), k), F.lit(0.0))
                 + F.coalesce(rrf_term(F.col("rank2"), k), F.lit(0.0)))
    else:
        raise ValueError(f"unknown missing rule {missing!r}")
    fused = both.withColumn("rerank", F.round(score, digits)).drop("n_union")
    return rank_within(fused, "rerank")


def rrf_many(runs: dict[str, DataFrame], k: int = 60, rank_base: int = 0,
             missing: str = "union_size", digits: int = 9) -> DataFrame:
    """n-list fusion: union tagged lists, one aggregation per (query_id, doc_id).

    Equal to :func:`rrf_two` for two lists. A missing rank counts as the
    per-query union size (or 0 contribution with ``missing='drop'``).
    Output: query_id, doc_id, n_lists, rerank, rnk.
    """
    n_lists = len(runs)
    tagged = [r.select("query_id", "doc_id", F.lit(name).alias("run"),
                       (F.col("rnk") - 1 + rank_base).cast("double").alias("r"))
              for name, r in runs.items()]
    allr = reduce(DataFrame.unionByName, tagged)
    per_doc = allr.groupBy("query_id", "doc_id").agg(
        F.sum(rrf_term(F.col("r"), k)).alias("present"), F.count(F.lit(1)).alias("n_lists"))
    if missing == "union_size":
        n = F.count(F.lit(1)).over(Window.partitionBy("query_id")).cast("double")
        score = F.col("present") + (F.lit(n_lists) - F.col("n_lists")) * rrf_term(n, k)
    elif missing == "drop":
        score = F.col("present")
    else:
        raise ValueError(f"unknown missing rule {missing!r}")
    fused = per_doc.withColumn("rerank", F.round(score, digits)).drop("present")
    return rank_within(fused, "rerank")


def rerank(answers: DataFrame, score: str = "rerank", out: str = "new_rnk") -> DataFrame:
    """Order each query's answers by a new score (descending, ties by doc_id).

    The input keeps its ``score``/``rnk``; the new order is ``out``. Nothing
    is modified in place.
    """
    return rank_within(answers, score, descending=True, out=out)
