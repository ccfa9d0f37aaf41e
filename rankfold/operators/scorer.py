"""A learned pair relevance scorer with Spark MLlib.

Re-aims the reference's fine-tuned pair classifier: a LogisticRegression over
per-pair features computed by joins against the index (BM25 score, term
overlap, document length, query length, hash-vector distance). P(relevant) is probability[1]
(class 1 = relevant) and can rerank any answer set.
"""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from rankfold.operators.encode import hash_vectors
from rankfold.operators.lexical import MAX_BROADCAST_QUERY_TERMS, LexicalIndex, bm25_scores, overlap_scores, query_terms
from rankfold.session import fits

FEATURES = ["bm25", "overlap", "log_dl", "nq", "l2"]


def vector_distances(pairs: DataFrame, query_vectors: DataFrame, doc_vectors: DataFrame, digits: int = 6, out: str = "l2") -> DataFrame:
    """Adds the squared L2 distance of each (query_id, doc_id) pair's vectors: keyed joins, no search.

    ``query_vectors``: query_id, embedding; ``doc_vectors``: doc_id, embedding. Null where a vector is missing.
    """
    x = pairs.join(query_vectors.select("query_id", F.col("embedding").alias("_qv")), "query_id", "left")
    x = x.join(doc_vectors.select("doc_id", F.col("embedding").alias("_dv")), "doc_id", "left")
    steps = F.zip_with("_qv", "_dv", lambda a, b: (a - b) * (a - b))
    x = x.withColumn(out, F.round(F.aggregate(steps, F.lit(0.0), lambda acc, v: acc + v), digits)).drop("_qv", "_dv")
    return x.select(*pairs.columns, out)


def pair_features(pairs: DataFrame, queries: DataFrame, index: LexicalIndex) -> DataFrame:
    """Adds the feature columns to (query_id, doc_id, ...) pairs: BM25, term overlap, document and query length, and the
    distance of the hash vectors, summed from the postings of the pairs' documents alone."""
    from rankfold.functions.text import tokenize

    keys = pairs.select("query_id").distinct()
    qsub = queries.join(keys, "query_id", "left_semi")
    bm = bm25_scores(qsub, index).withColumnRenamed("score", "bm25")
    f = overlap_scores(pairs, qsub, index, out="overlap")
    f = f.join(bm, ["query_id", "doc_id"], "left")
    f = f.join(index.doc_stats.select("doc_id", "dl"), "doc_id", "left")
    nq = qsub.select("query_id", F.size(tokenize("query")).cast("double").alias("nq"))
    f = (f.join(nq, "query_id", "left")
         .withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))
         .withColumn("log_dl", F.log1p(F.coalesce(F.col("dl"), F.lit(0)).cast("double")))
         .withColumn("nq", F.coalesce("nq", F.lit(0.0)))
         .drop("dl"))
    ids = pairs.select("doc_id").distinct()
    few = F.broadcast(ids) if fits(ids, MAX_BROADCAST_QUERY_TERMS) else ids
    doc_vectors = hash_vectors(index.postings.join(few, "doc_id", "left_semi"), ids)
    query_vectors = hash_vectors(query_terms(qsub), qsub, "query_id", "qtf")
    return vector_distances(f, query_vectors, doc_vectors)


def fit_scorer(train: DataFrame, max_iter: int = 50, reg: float = 0.01) -> PipelineModel:
    """Train on featured pairs with an INT ``label``."""
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep"),
        LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=reg),
    ])
    model = pipe.fit(train.withColumn("label", F.col("label").cast("double")))
    # The training summary holds the session, which tasks can't receive once something was observed in it.
    model.stages[-1]._java_obj.setSummary(train.sparkSession._jvm.scala.Option.apply(None))
    return model


def score_with(model: PipelineModel, featured: DataFrame, out: str = "rerank") -> DataFrame:
    """P(relevant) = probability[1]."""
    pred = model.transform(featured)
    return (pred.withColumn(out, vector_to_array("probability").getItem(1))
            .withColumn("predicted", F.col("prediction").cast("int"))
            .drop("features", "rawPrediction", "probability", "prediction"))


def quality(predictions: DataFrame) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 of the positive class."""
    lab, pre = F.col("label").cast("int"), F.col("predicted")
    agg = predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((lab == 1) & (pre == 1)).cast("long")).alias("tp"),
        F.sum(((lab == 0) & (pre == 1)).cast("long")).alias("fp"),
        F.sum(((lab == 1) & (pre == 0)).cast("long")).alias("fn"),
        F.sum(((lab == 0) & (pre == 0)).cast("long")).alias("tn"))
    sd = lambda a, b: F.when(b != 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))
    return agg.select("n", "tp", "fp", "fn", "tn",
                      sd(F.col("tp") + F.col("tn"), F.col("n")).alias("accuracy"),
                      sd(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                      sd(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
                      sd(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"))


def save_scorer(model: PipelineModel, root: str, stamp: str | None = None) -> str:
    """Save under a timestamped folder; returns the path."""
    from datetime import datetime, timezone

    stamp = stamp or datetime.now(timezone.utc).strftime("%Y-%m-%d_%H-%M-%S")
    path = os.path.join(root, f"pair-scorer-{stamp}")
    model.write().overwrite().save(path)
    return path


def load_scorer(path: str) -> PipelineModel:
    return PipelineModel.load(path)
