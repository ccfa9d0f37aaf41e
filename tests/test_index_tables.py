import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from rankfold.functions.text import decimals
from rankfold.operators import encode, judge, lexical, scorer
from rankfold.session import checkpoint_path, materialize, owned, path_exists
from rankfold.sources import tables as T


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_tells_what_the_build_has_read(spark, tiny_docs):
    for keep in (False, True):
        with lexical.build_index(tiny_docs, keep_text=keep) as idx:
            assert idx.profile == {"rows": 3, "texts": 3, "bytes": sum(len(r.text) for r in tiny_docs.collect())}
    assert lexical.build_index(tiny_docs.limit(0)).profile == {"rows": 0, "texts": 0, "bytes": 0}


def test_an_index_removes_what_it_has_written(spark, tiny_docs):
    with lexical.build_index(tiny_docs, keep_text=True) as idx:
        assert idx.doc_stats.count() == 3
        tables, paths = list(idx.owner.tables), list(idx.owner.paths)
        assert len(tables) == 3 and all(spark.catalog.tableExists(t) for t in tables) and all(path_exists(spark, p) for p in paths)
    assert not any(spark.catalog.tableExists(t) for t in tables) and not any(path_exists(spark, p) for p in paths)
    with owned(spark) as own:
        materialize(tiny_docs, "scratch")
        path, = own.paths
        assert path_exists(spark, path)
    assert not path_exists(spark, path)


def test_texts_are_verified_where_they_lie(spark):
    docs, qs = T.corpus(spark, SF001), T.text_queries(spark, SF001)
    idx = lexical.build_index(docs, keep_text=True)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(judge.containment_qrels(qs, docs, idx, materialize=False))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ShuffledHashJoin" in plan and "Exchange hashpartitioning(doc_id" not in plan
    assert rows(judge.containment_qrels(qs, docs, idx), "query_id", "doc_id") == rows(judge.containment_qrels(qs, docs, lexical.build_index(docs)),
                                                                                       "query_id", "doc_id")


def test_overlap_reads_the_postings_once(spark):
    docs, qs = T.corpus(spark, SF001), T.text_queries(spark, SF001)
    idx = lexical.build_index(docs)
    run = materialize(lexical.bm25_search(qs, idx, k=5), "run")
    plan = _plan(lexical.overlap_scores(run, qs, idx))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "_postings_" in line]
    assert len(scans) == 1


def test_hash_vectors_from_postings_equal_those_from_texts(spark):
    docs = T.corpus(spark, SF001).limit(80)
    idx = lexical.build_index(docs)
    got = encode.hash_vectors(idx.postings, docs)
    assert "Python" not in _plan(got) and "Arrow" not in _plan(got)
    cells = lambda df: rows(df.select("doc_id", F.posexplode("embedding").alias("i", "v")).withColumn("v", F.round("v", 9)), "doc_id", "i", "v")
    assert cells(got) == cells(docs.select("doc_id", encode.hash_embed("text").alias("embedding")))
    assert rows(encode.hash_cells(idx.postings), "doc_id", "dim", "value") == rows(encode.hash_embed_cells(docs, "doc_id", "text"), "doc_id", "dim", "value")


def test_hash_vectors_of_documents_without_terms(spark):
    docs = spark.createDataFrame([(1, "wing"), (2, None), (3, "a of the")], "doc_id long, text string")
    got = {r.doc_id: sum(abs(v) for v in r.embedding) for r in encode.hash_vectors(lexical.build_index(docs).postings, docs).collect()}
    assert got == {1: 1.0, 2: 0.0, 3: 0.0}


@pytest.mark.parametrize("pattern_bytes", [judge.PATTERN_BYTES, 60])
def test_keyless_passages_by_brute_force(spark, pattern_bytes):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab é.") for _ in range(rng.randrange(60))) for _ in range(50)] + [None, "", "ab" * 500]
    passages = ["".join(rng.choice("ab é.") for _ in range(rng.randrange(1, 5))) for _ in range(40)] + ["", None, "a", "a", "zzz", "aba"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    qs = spark.createDataFrame(list(enumerate(passages)), "query_id long, passage string")
    want = sorted((q, d) for q, p in enumerate(passages) for d, t in enumerate(texts) if p and t and p in t)
    assert rows(judge.multi_contains(docs, qs, pattern_bytes), "query_id", "doc_id") == want
    got = rows(judge.containment_qrels(qs, docs, query_col="passage"), "query_id", "doc_id")
    assert got == want


def test_pair_distances(spark):
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "query_id long, embedding array<double>")
    d = spark.createDataFrame([(10, [3.0, 4.0]), (11, [1.0, 0.0])], "doc_id long, embedding array<double>")
    pairs = spark.createDataFrame([(1, 10), (2, 11), (2, 10), (1, 99)], "query_id long, doc_id long")
    assert sorted(map(tuple, scorer.vector_distances(pairs, q, d).collect()), key=str) == [(1, 10, 25.0), (1, 99, None), (2, 10, 13.0), (2, 11, 1.0)]


def test_scores_as_text(spark):
    df = spark.createDataFrame([(0.5,), (1 / 3,), (0.000005,), (-2.0,), (None,)], "s double")
    assert [r[0] for r in df.select(decimals("s")).collect()] == ["0.50000", "0.33333", "0.00001", "-2.00000", None]


def test_scratch_folder_is_named_by_the_session(spark):
    assert checkpoint_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir")) and os.path.basename(checkpoint_path(spark, "x")) == "x"
