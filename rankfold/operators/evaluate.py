"""K1-K6: judging answer sets and precision/recall/F1 at every rank.

The reference re-sorts and re-scans the answer list for every cut-off
(quadratic per query); here one running-sum window per query gives all
cut-offs, and the whole query set is one plan keyed by query_id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from rankfold.functions.scoring import safe_div
from rankfold.schemas import require_columns
from rankfold.session import fits

#: Bytes of (id, label) rows that are sent to every task; as a hash table they take some three times as much.
LABEL_BYTES = 32 * 1024 * 1024


def judged_pairs(qrels: DataFrame, min_grade: int | None = None) -> DataFrame:
    """Distinct (query_id, doc_id) judgements; any grade counts unless ``min_grade``."""
    q = qrels
    if min_grade is not None and "grade" in q.columns:
        q = q.where(F.col("grade") >= min_grade)
    return q.select("query_id", "doc_id").distinct()


def relevant_counts(qrels: DataFrame) -> DataFrame:
    """query_id, n_rel (distinct judged documents)."""
    return judged_pairs(qrels).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))


def flag_relevant(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Adds ``relevant`` BOOLEAN by a left join on (query_id, doc_id)."""
    j = judged_pairs(qrels).withColumn("_hit", F.lit(True))
    return (run.join(j, ["query_id", "doc_id"], "left")
            .withColumn("relevant", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def flag_by_label(run: DataFrame, query_labels: DataFrame, doc_labels: DataFrame):
    """Label judgements (vectors): relevant when labels agree.

    Returns (flagged run, n_rel per query). n_rel = documents sharing the
    query's label minus the query itself when it is in the corpus. The
    judgement pairs are never materialised (a label can hold a third of the
    corpus); only one count per label is shuffled.
    """
    ql = query_labels.select("query_id", F.col("label").alias("q_label"))
    dl = doc_labels.select("doc_id", F.col("label").alias("d_label"))
    # a run is far larger than the labels: it stays where it lies, or moves once for each id, by query last (as its ranks need)
    small = [F.broadcast(x) if fits(x, max_bytes=LABEL_BYTES) else x for x in (dl, ql)]
    flagged = (run.join(small[0], "doc_id").join(small[1], "query_id")
               .withColumn("relevant", F.col("q_label") == F.col("d_label"))
               .select("doc_id", "query_id", *(c for c in run.columns if c not in ("doc_id", "query_id")), "relevant"))
    per_label = dl.groupBy(F.col("d_label").alias("q_label")).agg(F.count(F.lit(1)).alias("n_lab"))
    self_in = ql.join(dl, ql.query_id == dl.doc_id, "left_semi").select("query_id").withColumn("_self", F.lit(1))
    n_rel = (ql.join(per_label, "q_label", "left").join(self_in, "query_id", "left")
             .select("query_id", (F.coalesce("n_lab", F.lit(0)) - F.coalesce("_self", F.lit(0)))
                     .cast("long").alias("n_rel")))
    return flagged, n_rel


def metric_curve(flagged: DataFrame, n_rel: DataFrame, max_num: int = 100,
                 rank_col: str = "rnk", digits: int = 9) -> DataFrame:
    """K1: query_id, top_k, tp, n_rel, precision, recall, f1 for ranks 1..min(max_num, n).

    ``rank_col`` must be contiguous from 1 per query. precision = tp/top_k,
    recall = tp/n_rel (0 when n_rel = 0), f1 = 2tp/(top_k + n_rel) (0 when tp = 0).
    Only queries present in ``n_rel`` are evaluated (inner semantics).
    """
    require_columns(flagged, "query_id", rank_col, "relevant", what="flagged run")
    require_columns(n_rel, "query_id", "n_rel", what="relevant counts")
    w = (Window.partitionBy("query_id").orderBy(rank_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = (flagged.where(F.col(rank_col) <= max_num)
           .withColumn("tp", F.sum(F.col("relevant").cast("long")).over(w)))
    run = run.join(n_rel, "query_id")
    top = F.col(rank_col).cast("int")
    return run.select(
        "query_id",
        top.alias("top_k"),
        F.col("tp").cast("long").alias("tp"),
        F.col("n_rel").cast("long").alias("n_rel"),
        F.round(safe_div(F.col("tp"), top), digits).alias("precision"),
        F.round(safe_div(F.col("tp"), F.col("n_rel")), digits).alias("recall"),
        F.round(safe_div(2 * F.col("tp"), top + F.col("n_rel")), digits).alias("f1"),
    )


def mean_curve(curve: DataFrame, digits: int = 9, by: list[str] | None = None) -> DataFrame:
    """Plain mean over the queries that reach each rank (Q9)."""
    keys = (by or []) + ["top_k"]
    return curve.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg("precision"), digits).alias("precision"),
        F.round(F.avg("recall"), digits).alias("recall"),
        F.round(F.avg("f1"), digits).alias("f1"),
    )


def evaluate(run: DataFrame, qrels: DataFrame, max_num: int = 100, rank_col: str = "rnk") -> DataFrame:
    """K2: per-query curve of a run against (query_id, doc_id) judgements."""
    return metric_curve(flag_relevant(run, qrels), relevant_counts(qrels), max_num, rank_col)


def run_summary(flagged: DataFrame, n_rel: DataFrame) -> DataFrame:
    """Per judged query: answer size, judged total, retrieved relevant, missing.

    A judged query without any answer is kept, with zero answers and all missing.
    """
    agg = flagged.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.sum(F.col("relevant").cast("long")).alias("n_retrieved_relevant"))
    return (n_rel.join(agg, "query_id", "left").fillna(0, subset=["n_answers", "n_retrieved_relevant"])
            .select("query_id", "n_answers", F.col("n_rel").cast("long").alias("n_rel"),
                    F.col("n_retrieved_relevant").cast("long").alias("n_retrieved_relevant"),
                    (F.col("n_rel") - F.col("n_retrieved_relevant")).cast("long").alias("n_missing")))


def missing_documents(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """Judged documents absent from the answer set (left anti join)."""
    return judged_pairs(qrels).join(run.select("query_id", "doc_id"), ["query_id", "doc_id"], "left_anti")


def method_table(curves: dict[str, DataFrame], at: int = 5) -> DataFrame:
    """K5: one row per method at one cut-off, from mean curves."""
    parts = [c.where(F.col("top_k") == at).select(F.lit(name).alias("method"), "top_k", "n_queries",
                                                   "precision", "recall", "f1")
             for name, c in curves.items()]
    return reduce(DataFrame.unionByName, parts)


def attach(run: DataFrame, qrels: DataFrame | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """Add ``relevant`` (from qrels) and ``text`` (from the corpus) only
    when the run does not carry them yet; a new DataFrame, the input is unchanged.
    The corpus side is de-duplicated by doc_id so answers never fan out."""
    out = run
    if "relevant" not in out.columns and qrels is not None:
        out = flag_relevant(out, qrels)
    if "text" not in out.columns and corpus is not None:
        texts = corpus.select("doc_id", "text").groupBy("doc_id").agg(F.min("text").alias("text"))
        out = out.join(texts, "doc_id", "left")
    return out
