import pytest
from pyspark.sql import functions as F

from rankfold.operators import lexical
from conftest import rows

# FIXTURES.md section 3: k1=1.5, b=0.75, lengths 3, 2, 4, avgdl 3
LUCENE = {("flow wing", 1): 0.660905, ("flow wing", 2): 0.221178, ("flow flow wing", 1): 0.929479,
          ("flow flow wing", 2): 0.442356, ("heat", 2): 0.221178, ("heat", 3): 0.242583}


@pytest.fixture(scope="module")
def index(tiny_docs):
    return lexical.build_index(tiny_docs)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "flow wing"), (2, "flow flow wing"), (3, "heat")],
                                 "query_id long, query string")


def _scores(run, queries):
    q = {r["query_id"]: r["query"] for r in queries.collect()}
    return {(q[a], b): s for a, b, s in rows(run, "query_id", "doc_id", "score")}


def test_corpus_stats(index):
    r = index.corpus_stats.first()
    assert (r["n_docs"], r["total_len"], r["avgdl"]) == (3, 9, 3.0)
    assert dict(rows(index.term_stats, "term", "df"))["flow"] == 2


def test_lucene_golden(index, queries):
    got = _scores(lexical.bm25_search(queries, index, k=10), queries)
    assert got == pytest.approx(LUCENE, abs=1e-6)
    assert set(got) == set(LUCENE)  # documents sharing no term are absent


def test_okapi_is_scaled(index, queries):
    got = _scores(lexical.bm25_search(queries, index, k=10, variant="okapi"), queries)
    assert got[("flow wing", 1)] == pytest.approx(1.652263, abs=1e-6)
    assert got[("heat", 3)] == pytest.approx(0.606456, abs=1e-6)
    assert got == pytest.approx({k: round(v * 2.5, 6) for k, v in LUCENE.items()}, abs=2e-6)


def test_ranks_and_k(index, queries):
    run = lexical.bm25_search(queries, index, k=1)
    assert rows(run, "query_id", "doc_id", "rnk") == [(1, 1, 1), (2, 1, 1), (3, 3, 1)]


def test_padding(index, queries, tiny_docs):
    run = lexical.bm25_search_padded(queries, index, tiny_docs, k=3)
    got = rows(run.where("query_id = 1"), "rnk", "doc_id", "score")
    assert got == [(1, 1, 0.660905), (2, 2, 0.221178), (3, 3, 0.0)]


def test_query_without_terms(index, spark):
    q = spark.createDataFrame([(9, "the of and"), (8, "")], "query_id long, query string")
    assert lexical.bm25_search(q, index, k=5).count() == 0


def test_partition_invariance(spark, queries, tiny_docs):
    base = rows(lexical.bm25_search(queries, lexical.build_index(tiny_docs), k=3), "query_id", "doc_id", "rnk")
    for n in (1, 3, 17):
        idx = lexical.build_index(tiny_docs.repartition(n))
        assert rows(lexical.bm25_search(queries.repartition(n), idx, k=3), "query_id", "doc_id", "rnk") == base


def test_top_k_plan_uses_window_group_limit(index, queries):
    plan = lexical.bm25_search(queries, index, k=10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedupe_modes(spark):
    docs = spark.createDataFrame([(1, "flow heat"), (2, "flow heat"), (1, "flow heat")], "doc_id long, text string")
    assert lexical.build_index(docs, dedupe="doc_id").corpus_stats.first()["n_docs"] == 2
    assert lexical.build_index(docs, dedupe="text").corpus_stats.first()["n_docs"] == 1


def test_overlap_scores_match_expression(spark, index, tiny_docs, queries):
    from rankfold.operators.encode import token_overlap

    pairs = lexical.bm25_search(queries, index, k=3)
    a = rows(lexical.overlap_scores(pairs, queries, index), "query_id", "doc_id", "rerank")
    b = pairs.join(queries, "query_id").join(tiny_docs, "doc_id").select(
        "query_id", "doc_id", F.round(token_overlap("query", "text"), 9).alias("rerank"))
    assert a == rows(b, "query_id", "doc_id", "rerank")


def test_save_and_load_index(spark, index, queries, tmp_path):
    lexical.save_index(index, str(tmp_path / "idx"))
    back = lexical.load_index(spark, str(tmp_path / "idx"))
    a = rows(lexical.bm25_search(queries, index, k=3), "query_id", "doc_id", "score")
    assert rows(lexical.bm25_search(queries, back, k=3), "query_id", "doc_id", "score") == a


def test_search_scores_inside_shards(spark):
    """The materialised index is bucketed by doc_id: scoring aggregates per
    (query, document) with no exchange of candidate pairs; only per-shard
    top-k rows are shuffled (by query_id)."""
    import re

    from rankfold.sources import tables as T

    sf = "/root/testdata/sf0.001"
    idx = lexical.build_index(T.corpus(spark, sf))
    run = lexical.bm25_search(T.text_queries(spark, sf), idx, k=10)
    run.collect()
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\(query_id#\d+L, doc_id", plan)
    assert re.search(r"Exchange hashpartitioning\(query_id#\d+L, \d+\)", plan)
    assert "WindowGroupLimit" in plan


def test_large_query_set_path_equals_broadcast_path(index, queries):
    a = rows(lexical.bm25_search(queries, index, k=3), "query_id", "doc_id", "score", "rnk")
    b = rows(lexical.bm25_search(queries, index, k=3, broadcast_limit=1), "query_id", "doc_id", "score", "rnk")
    # 5 (query, term) rows, 3 vocabulary terms: limit 4 takes the pruned-postings path
    c = rows(lexical.bm25_search(queries, index, k=3, broadcast_limit=4), "query_id", "doc_id", "score", "rnk")
    assert a == b == c


def test_save_as_bucketed_tables_keeps_shard_local_search(spark, index, queries, tmp_path):
    lexical.save_index(index, str(tmp_path / "tidx"), table_prefix="rankfold_test_idx", shards=4)
    back = lexical.load_index(spark, str(tmp_path / "tidx"), table_prefix="rankfold_test_idx")
    run = lexical.bm25_search(queries, back, k=3)
    assert rows(run, "query_id", "doc_id", "score") == rows(lexical.bm25_search(queries, index, k=3),
                                                            "query_id", "doc_id", "score")
    run.collect()
    assert "Bucketed: true" in run._jdf.queryExecution().executedPlan().toString()


def test_index_statistics_are_stored_and_postings_not_shuffled(spark):
    from rankfold.sources import tables as T

    sf = "/root/testdata/sf0.001"
    docs, qs = T.corpus(spark, sf), T.text_queries(spark, sf)
    idx = lexical.build_index(docs)
    run = lexical.bm25_search(qs, idx, k=5)
    plan = run._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len([line for line in scans if "rankfold_postings" in line]) == 1
    assert not any("documents" in line for line in scans)
    pairs = run.select("query_id", "doc_id")
    small = rows(lexical.overlap_scores(pairs, qs, idx), "query_id", "doc_id", "rerank")
    large = lexical.overlap_scores(pairs, qs, idx, broadcast_limit=0)
    assert rows(large, "query_id", "doc_id", "rerank") == small
    assert rows(lexical.corpus_statistics(docs), "n_docs", "total_len", "avgdl") == rows(
        idx.corpus_stats, "n_docs", "total_len", "avgdl")


def test_shards_follow_the_bytes_read(spark):
    from rankfold import session
    from rankfold.sources import tables as T

    docs = T.corpus(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        assert session.default_shards(spark, docs) > int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
        dedup = lexical.index_documents(docs, "text")
        assert session.input_bytes(dedup) == session.input_bytes(docs)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_shard_keeps_its_size_as_the_input_grows(spark, monkeypatch):
    from rankfold import session

    docs = spark.range(1)
    for size in (1 << 20, 1 << 30, 6 << 30, 30 << 30):
        monkeypatch.setattr(session, "input_bytes", lambda _, size=size: size)
        assert size / session.default_shards(spark, docs) <= session.SHARD_BYTES <= 8 << 20


def test_shards_follow_the_texts_where_files_hold_them_once(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from rankfold import session

    one = " ".join(f"w{i}" for i in range(5000))
    spark.range(400).select(F.col("id").alias("doc_id"), F.lit(one).alias("text")).coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    texts, limit = 400 * len(one), 100_000
    assert session.input_bytes(docs) < texts / 20
    monkeypatch.setattr(session, "SHARD_BYTES", limit)
    with lexical.build_index(docs) as idx:
        assert idx.shards >= texts / limit > 2 * spark.sparkContext.defaultParallelism
        assert idx.postings.count() == 400 * 5000
    plan = lexical.build_index(docs, materialize=False).postings
    assert plan.rdd.getNumPartitions() >= texts / limit


def test_padding_scores_only_the_documents_it_may_add(spark):
    rows_ = [(i, "wing flow" if i % 2 else "heat shock") for i in range(60)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    queries = spark.createDataFrame([(1, "wing"), (2, "heat"), (3, "nothing")], "query_id long, query string")
    with lexical.build_index(docs) as idx:
        padded = lexical.bm25_search_padded(queries, idx, docs, k=40)
        got = {q: [r.doc_id for r in sorted(padded.where(f"query_id = {q}").collect(), key=lambda r: r.rnk)] for q in (1, 2, 3)}
        odd, even = list(range(1, 60, 2)), list(range(0, 60, 2))
        assert got == {1: odd + even[:10], 2: even + odd[:10], 3: list(range(40))}
        plan = padded._jdf.queryExecution().optimizedPlan().toString()
        assert any("Filter" in line and "array_contains" in line for line in plan.splitlines())
