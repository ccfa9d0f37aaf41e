"""Scoring expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num/den as DOUBLE, 0.0 when den is 0 (ANSI mode would raise)."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def idf(n_docs: Column, df: Column) -> Column:
    """ln(1 + (N - df + 0.5) / (df + 0.5))."""
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25_weight(qtf: Column, idf_col: Column, tf: Column, dl: Column, avgdl: Column,
                k1: float = 1.5, b: float = 0.75, variant: str = "lucene") -> Column:
    """Contribution of one (query term, document) posting to the BM25 score."""
    w = qtf * idf_col * tf / (tf + F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * dl / avgdl))
    if variant == "okapi":
        w = w * F.lit(k1 + 1.0)
    elif variant != "lucene":
        raise ValueError(f"unknown BM25 variant {variant!r}")
    return w


def rrf_term(rank: Column, k: int = 60) -> Column:
    """1 / (k + rank)."""
    return F.lit(1.0) / (F.lit(float(k)) + rank.cast("double"))


def softmax_positive(logits: Column) -> Column:
    """P(class 1) from a two-logit array; a one-element array passes through."""
    x0 = F.element_at(logits, 1).cast("double")
    x1 = F.element_at(logits, 2).cast("double")
    two = F.lit(1.0) / (F.lit(1.0) + F.exp(x0 - x1))
    return F.when(F.size(logits) == 1, x0).otherwise(two)
