import numpy as np
import pytest
from pyspark.sql import functions as F

from rankfold.operators import encode, lexical, scorer
from rankfold.sources import io
from conftest import rows


def test_user_encoder_hook(spark):
    # factories are defined inside the test so they are shipped by value
    def make_len_encoder():
        import numpy as np

        def predict(texts):
            return np.stack([[float(len(t)), float(t.count(" "))] for t in texts]).astype(np.float32)

        return predict

    df = spark.createDataFrame([(1, "ab cd"), (2, "x")], "doc_id long, text string")
    got = {r["doc_id"]: list(r["embedding"]) for r in encode.encode_with(df, "text", make_len_encoder, 2).collect()}
    assert got == {1: [5.0, 1.0], 2: [1.0, 0.0]}


def test_user_pair_model_softmax(spark):
    def make_pair_model():
        import numpy as np

        def predict(q, t):
            # two logits: class 1 grows with shared characters
            shared = np.array([len(set(a) & set(b)) for a, b in zip(q, t)], dtype=np.float64)
            return np.stack([np.zeros_like(shared), shared / 10.0], axis=1)

        return predict

    df = spark.createDataFrame([(1, "abc", "abz"), (2, "abc", "xyz")], "query_id long, query string, text string")
    got = dict(rows(encode.score_pairs_with(df, make_pair_model), "query_id", "rerank"))
    assert got[1] == pytest.approx(1 / (1 + np.exp(-0.2)))
    assert got[2] == pytest.approx(0.5)


def test_hash_embed_is_unit_norm_and_deterministic(spark):
    df = spark.createDataFrame([(1, "wing flow flow heat"), (2, ""), (3, "the of")], "doc_id long, text string")
    v = {r["doc_id"]: np.array(r["v"]) for r in df.select("doc_id", encode.hash_embed("text").alias("v")).collect()}
    assert np.linalg.norm(v[1]) == pytest.approx(1.0)
    assert not v[2].any() and not v[3].any() and len(v[2]) == 64


def test_write_tables_and_per_query(spark, tmp_path):
    a = spark.createDataFrame([(1, 2, True)], "query_id long, doc_id long, relevant boolean")
    paths = io.write_tables({"train": a, "test": a}, str(tmp_path / "splits"))
    assert rows(spark.read.json(paths["train"]), "query_id", "doc_id", "relevant") == [(1, 2, "yes")]
    run = spark.createDataFrame([(1, 5, "what is it.", 0.5), (2, 6, "other", 0.1)],
                                "query_id long, doc_id long, query string, score double")
    io.write_per_query(run, str(tmp_path / "pq"), fmt="json")
    back = spark.read.json(str(tmp_path / "pq"))
    assert rows(back, "query_id", "doc_id", "query_slug") == [(1, 5, "what_is_it"), (2, 6, "other")]
    io.write_per_query(run, str(tmp_path / "pb"), fmt="json", buckets=4)
    assert spark.read.json(str(tmp_path / "pb")).count() == 2


def test_scorer_fit_save_load(spark, tmp_path, tiny_docs):
    idx = lexical.build_index(tiny_docs)
    qs = spark.createDataFrame([(1, "flow wing"), (2, "heat")], "query_id long, query string")
    pairs = spark.createDataFrame([(1, 1, 1), (1, 3, 0), (2, 3, 1), (2, 1, 0), (1, 2, 1), (2, 2, 0)],
                                  "query_id long, doc_id long, label int")
    feat = scorer.pair_features(pairs, qs, idx)
    model = scorer.fit_scorer(feat)
    pred = scorer.score_with(model, feat)
    assert pred.where(F.col("rerank").isNull()).count() == 0
    path = scorer.save_scorer(model, str(tmp_path), stamp="t0")
    again = scorer.score_with(scorer.load_scorer(path), feat)
    assert rows(again, "query_id", "doc_id", "rerank") == rows(pred, "query_id", "doc_id", "rerank")
    q = scorer.quality(pred).first()
    assert q["n"] == 6 and 0.0 <= q["accuracy"] <= 1.0
