import random

import pytest

from conftest import SF001, rows
from rankfold.operators import impact, lexical
from rankfold.sources import tables as T


def _answers(df):
    return rows(df, "query_id", "rnk", "doc_id", "score")


@pytest.mark.parametrize("k, levels", [(1, 32), (10, 32), (10, 1), (500, 4)])
def test_equals_the_exhaustive_search(spark, k, levels):
    docs, qs = T.corpus(spark, SF001), T.text_queries(spark, SF001)
    idx = lexical.build_index(docs)
    counts = {}
    got = impact.impact_search(qs, impact.build_impacts(idx, levels=levels), k=k, counts=counts)
    assert _answers(got) == _answers(lexical.bm25_search(qs, idx, k=k))
    assert counts["there"] > 0 and counts["candidates"] >= got.count()


@pytest.mark.parametrize("seed", range(3))
def test_random_corpora(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words, weights, k=rng.randrange(0, 30)))) for i in range(300)], "doc_id long, text string")
    qs = spark.createDataFrame([(i, " ".join(rng.choices(words, k=rng.randrange(0, 6)))) for i in range(20)], "query_id long, query string")
    idx = lexical.build_index(docs)
    imp, counts = impact.build_impacts(idx), {}
    for variant_k in (1, 3, 20):
        got = impact.impact_search(qs, imp, k=variant_k, seed_share=rng.choice([0.0, 0.1, 1.0]))
        assert _answers(got) == _answers(lexical.bm25_search(qs, idx, k=variant_k))
    impact.impact_search(qs, imp, k=1, counts=counts)
    assert counts["read"] <= 2 * counts["there"]
    imp.drop()


def test_rare_terms_spare_the_postings_of_frequent_ones(spark):
    docs = spark.createDataFrame([(i, "common words here " + ("rare gem" if i < 3 else f"filler{i}")) for i in range(2000)], "doc_id long, text string")
    qs = spark.createDataFrame([(1, "common words rare gem")], "query_id long, query string")
    idx, counts = lexical.build_index(docs), {}
    got = impact.impact_search(qs, impact.build_impacts(idx), k=3, counts=counts)
    assert [(r.doc_id, r.rnk) for r in got.orderBy("rnk").collect()] == [(0, 1), (1, 2), (2, 3)]
    assert counts["read"] < 0.02 * counts["there"] and counts["candidates"] == 3


def test_no_matches(spark, tiny_docs):
    idx = impact.build_impacts(lexical.build_index(tiny_docs))
    qs = spark.createDataFrame([(1, "unknown"), (2, ""), (3, None)], "query_id long, query string")
    assert impact.impact_search(qs, idx).count() == 0
    assert impact.impact_search(qs.limit(0), idx).count() == 0
    none = impact.build_impacts(lexical.build_index(tiny_docs.limit(0)))
    assert impact.impact_search(qs, none).count() == 0
