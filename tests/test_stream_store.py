import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from rankfold import streaming
from rankfold.operators import encode, lexical, rank
from rankfold.sources import tables as T
from rankfold.streaming import ingest


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    docs = T.corpus(spark, SF001).where("doc_id < 60").cache()
    root = str(tmp_path_factory.mktemp("ingest") / "root")
    profiles = [streaming.ingest_batch(docs.where(f"doc_id % 3 = {b}"), b, root) for b in range(3)]
    return docs, root, profiles


def _cells(df):
    return rows(df.select("doc_id", F.posexplode("embedding").alias("dim", "v")).where("v <> 0").withColumn("v", F.round("v", 9)), "doc_id", "dim", "v")


def test_stored_vectors_equal_the_batch_build(spark, world):
    docs, root, _ = world
    snap = streaming.snapshot(spark, root)
    want = encode.hash_vectors(lexical.build_index(docs, materialize=False).postings, docs)
    assert _cells(snap.vectors().vectors()) == _cells(want)
    assert rows(snap.documents(), "doc_id", "text") == rows(docs, "doc_id", "text")


def test_profiles_are_observed_counts(spark, world):
    docs, root, profiles = world
    want = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first().asDict()
    assert {k: sum(p[k] for p in profiles) for k in want} == want
    assert streaming.snapshot(spark, root).profile() == want


def test_replayed_and_repeated_batches_change_nothing(spark, world):
    docs, root, _ = world
    before = streaming.snapshot(spark, root)
    state = lambda s: (rows(s.index().term_stats, "term", "df"), s.index().corpus_stats.first(), _cells(s.vectors().vectors()))
    want = state(before)
    streaming.ingest_batch(docs.where("doc_id % 3 = 1"), 1, root)  # replayed
    assert streaming.ingest_batch(docs, 7, root)["rows"] == 0  # known documents under a new batch, twice
    assert streaming.ingest_batch(docs, 7, root)["rows"] == 0
    assert state(streaming.snapshot(spark, root)) == want and state(before) == want


def test_a_batch_is_visible_as_a_whole_or_not_at_all(spark, world, tmp_path, monkeypatch):
    docs, _, _ = world
    root = str(tmp_path / "root")
    streaming.ingest_batch(docs.where("doc_id < 20"), 0, root)
    pinned = streaming.snapshot(spark, root)

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest.VectorStore, "append", fail)
        with pytest.raises(RuntimeError):
            streaming.ingest_batch(docs.where("doc_id >= 20"), 1, root)
    half = streaming.snapshot(spark, root)
    assert half.batches == (0,) and half.documents().count() == 20 and half.index().corpus_stats.first()["n_docs"] == 20
    assert half.vectors().count() == half.vectors().vectors().count() == 20
    streaming.ingest_batch(docs.where("doc_id >= 20"), 1, root)  # tried again
    whole = streaming.snapshot(spark, root)
    assert whole.documents().count() == docs.count() == whole.vectors().vectors().count()
    assert pinned.documents().count() == 20 and pinned.vectors().vectors().count() == 20


def test_only_the_batch_s_ids_are_shuffled(spark, world):
    docs, root, _ = world
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = ingest.new_documents(docs.where("doc_id < 30"), 50, root)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    right = plan[plan.rindex("Sort"):]  # the id table's side
    assert "FileScan parquet" in right and "Exchange" not in right and "Bucketed: true" in right
    assert "GreaterThanOrEqual(doc_id" in right and "LessThanOrEqual(doc_id" in right


def test_merged_sketches_lie_within_their_error(spark, world):
    docs, root, _ = world
    snap = streaming.snapshot(spark, root)
    got = {r.counted: r.estimate for r in snap.distinct_counts().collect()}
    terms = snap.index().term_stats.count()
    assert abs(got["term"] - terms) <= 5 * 1.04 / 2 ** (ingest.SKETCH_BITS / 2) * terms
    assert abs(got["doc_id"] - docs.count()) <= 3


def test_string_ids(spark, tmp_path):
    rows_ = [("a", "wing flow flow"), ("b", "flow heat"), ("c", "heat heat shock wave"), ("d", None)]
    docs = spark.createDataFrame(rows_, "doc_id string, text string")
    src, root = str(tmp_path / "src"), str(tmp_path / "root")
    docs.repartition(2).write.parquet(src)
    streaming.start_ingest(spark, src, root, str(tmp_path / "ck"), schema="doc_id string, text string").awaitTermination()
    snap = streaming.snapshot(spark, root)
    qs = spark.createDataFrame([("q1", "flow wing")], "query_id string, query string")
    got = streaming.snapshot_retriever(snap, 3)(qs).collect()
    assert got[0].doc_id == "a" and {r.doc_id for r in got} >= {"a", "b"}


def test_fused_answers_of_a_pinned_snapshot_equal_batch_fusion(spark, world, tmp_path):
    docs, root, _ = world
    qs = T.text_queries(spark, SF001)
    src, out = str(tmp_path / "q"), str(tmp_path / "a")
    qs.repartition(2).write.parquet(src)
    retrieve = streaming.snapshot_retriever(streaming.snapshot(spark, root), 7)
    streaming.ingest_batch(spark.createDataFrame([(10 ** 6, "never seen words of another document")], "doc_id long, text string"), 60, root)
    streaming.start_answering(spark, src, retrieve, out, checkpoint=str(tmp_path / "ck")).awaitTermination()
    idx = lexical.build_index(docs)
    from rankfold.operators import vectors

    vec = vectors.knn_search(encode.hash_vectors(lexical.query_terms(qs), qs, "query_id", "qtf"), encode.hash_vectors(idx.postings, docs), k=7)
    want = rank.rrf_two(lexical.bm25_search(qs, idx, k=7), vec)
    cols = ("query_id", "doc_id", "rank1", "rank2", "rerank", "rnk")
    assert rows(streaming.read_answers(spark, out), *cols) == rows(want, *cols)
    assert os.path.isdir(out)


def test_null_ids_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "root")
    some = spark.createDataFrame([(None, "lost"), (1, "kept text"), (1, "kept text again"), (2, None)], "doc_id long, text string")
    assert streaming.ingest_batch(some.limit(0), 0, root)["rows"] == 0
    assert streaming.ingest_batch(some, 1, root)["rows"] == 2
    assert rows(streaming.snapshot(spark, root).documents(), "doc_id") == [(1,), (2,)]
    with pytest.raises(ValueError, match="no batch"):
        streaming.snapshot(spark, str(tmp_path / "none")).documents()


def test_compacted_index_equals_the_snapshot(spark, world, tmp_path):
    _, root, _ = world
    got, want = streaming.compact_index(spark, root, str(tmp_path / "flat")), streaming.snapshot(spark, root).index()
    for table, cols in (("postings", ("term", "doc_id", "dl", "tf")), ("term_stats", ("term", "df")), ("doc_stats", ("doc_id", "dl", "n_terms"))):
        assert rows(getattr(got, table), *cols) == rows(getattr(want, table), *cols)
    assert got.corpus_stats.first() == want.corpus_stats.first()
