from pyspark.sql import functions as F

from rankfold.operators import judge, training
from conftest import rows


def test_containment_exact(spark):
    docs = spark.createDataFrame([
        (1, "The flow heat shock wave passes."), (2, "a reflow heat shock waves"), (3, "heat shock"),
        (4, "FLOW HEAT SHOCK WAVE"), (5, "other text entirely")], "doc_id long, text string")
    qs = spark.createDataFrame([
        (1, "low heat shock wav"),   # partial words at both ends
        (2, "heat shock"),           # two runs: no interior term -> exact scan path
        (3, "flow heat shock wave"), # case-sensitive
        (4, "of the a"),             # only stop words inside
    ], "query_id long, query string")
    got = rows(judge.containment_qrels(qs, docs), "query_id", "doc_id")
    want = sorted((q, d) for q, qt in [(1, "low heat shock wav"), (2, "heat shock"), (3, "flow heat shock wave"),
                                       (4, "of the a")]
                  for d, dt in [(1, "The flow heat shock wave passes."), (2, "a reflow heat shock waves"),
                                (3, "heat shock"), (4, "FLOW HEAT SHOCK WAVE"), (5, "other text entirely")]
                  if qt in dt)
    assert got == want


def test_containment_matches_brute_force_on_data(spark):
    from rankfold.sources import tables as T

    sf = "/root/testdata/sf0.001"
    docs, qs = T.corpus(spark, sf), T.text_queries(spark, sf)
    got = rows(judge.containment_qrels(qs, docs), "query_id", "doc_id")
    d = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = sorted((r["query_id"], i) for r in qs.collect() for i, t in d.items() if r["query"] in t)
    assert got == want


def _judged(spark):
    items = []
    for q in range(6):
        for j in range(q + 1):
            items.append((q, f"query {q}", 100 + (q * 7 + j) % 23, f"text {(q * 7 + j) % 23}"))
    df = spark.createDataFrame(items, "query_id long, query string, doc_id long, text string")
    return df.dropDuplicates(["query_id", "doc_id"])


def test_split_by_query_takes_largest(spark):
    train, test = training.split_by_query(_judged(spark), 2)
    assert sorted({r["query_id"] for r in test.collect()}) == [4, 5]
    assert train.join(test, "query_id", "left_semi").count() == 0


def test_negative_pairs(spark):
    judged = _judged(spark)
    negs = training.negative_pairs(judged, seed=42)
    pos = {(r["query_id"], r["doc_id"]) for r in judged.collect()}
    n_pos = {}
    for q, _ in pos:
        n_pos[q] = n_pos.get(q, 0) + 1
    got = rows(negs, "query_id", "doc_id")
    assert not (set(got) & pos)
    assert len(got) == len(set(got))
    per_q = {}
    for q, _ in got:
        per_q[q] = per_q.get(q, 0) + 1
    assert per_q == n_pos
    assert rows(training.negative_pairs(judged.repartition(3), seed=42), "query_id", "doc_id") == got
    assert rows(training.negative_pairs(judged, seed=7), "query_id", "doc_id") != got


def test_negative_plan_has_no_pair_product(spark):
    plan = training.negative_pairs(_judged(spark))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_exact_group_split_samples_the_floor_of_the_share(spark, monkeypatch):
    monkeypatch.setattr(training, "_RING_BUCKET", 4)  # many buckets
    pairs = spark.range(203).selectExpr("id as query_id", "id % 7 as doc_id", "1 as label")
    tr, va = training.group_split(pairs, 0.25, 42, exact=True)
    assert (tr.count(), va.count()) == (50, 153)
    h = training.md5_long(F.lit(42), F.col("query_id"), F.col("doc_id"), F.col("label"))
    first = {r[0] for r in pairs.orderBy(h).limit(50).collect()}
    assert {r["query_id"] for r in tr.collect()} == first
    none, rest = training.group_split(pairs.where("query_id < 3"), 0.25, 42, exact=True)
    assert (none.count(), rest.count()) == (0, 3)
    assert [x.count() for x in training.group_split(pairs.limit(0), exact=True)] == [0, 0]


def test_label_profile_counts_rows_per_label(spark):
    a = spark.createDataFrame([(1, 1, 1), (1, 2, 0), (2, 3, 0)], "query_id long, doc_id long, label int")
    got = training.label_profile({"train": a, "validation": a.limit(0)}).collect()
    assert sorted(map(tuple, got)) == [("train", 0, 2), ("train", 1, 1)]


def test_group_split_partitions_queries(spark):
    pairs = training.training_pairs(_judged(spark))
    tr, va = training.group_split(pairs, 0.25, 42)
    assert tr.count() + va.count() == pairs.count()
    assert tr.select("query_id").intersect(va.select("query_id")).count() == 0


def test_labelled_pairs_truncate_and_encode(spark):
    df = spark.createDataFrame([(1, 2, "q", "x" * 6000, "yes"), (1, 3, "q", "short", "no")],
                               "query_id long, doc_id long, query string, text string, label string")
    out = {r["doc_id"]: (len(r["text"]), r["label"]) for r in training.labelled_pairs(df, max_chars=5000).collect()}
    assert out == {2: (5000, 1), 3: (5, 0)}
    whole = {r["doc_id"]: len(r["text"]) for r in training.labelled_pairs(df).collect()}
    assert whole == {2: 6000, 3: 5}


def test_many_out_of_vocabulary_passages_match_nothing(spark):
    docs = spark.createDataFrame([(1, "flow heat shock wave")], "doc_id long, text string")
    qs = spark.range(12_000).selectExpr("id AS query_id", "concat('aa zz', id, ' yy', id, ' bb') AS query")
    assert judge.containment_qrels(qs, docs).count() == 0


def test_short_passages_match_brute_force(spark):
    texts = ["heat shock", "a", "", None, "xx  heat shock\nwave", "été naïf \U0001f600 ok", "aaaa", "HEAT", "\U0001f600"]
    passages = ["heat shock", "a", "aa", " ", "\n", "shock\nwa", "t s", "naïf", "\U0001f600", "heat shock\nwaves",
                "of the a", "", None, "heat shock", "zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    qs = spark.createDataFrame(list(enumerate(passages)), "query_id long, query string")
    want = sorted((i, j) for i, p in enumerate(passages) for j, t in enumerate(texts) if p and t and p in t)
    assert rows(judge.containment_qrels(qs, docs), "query_id", "doc_id") == want
    none = spark.createDataFrame([], "doc_id long, text string")
    assert judge.containment_qrels(qs, none).count() == 0
    assert judge.containment_qrels(qs.limit(0), docs).count() == 0


def test_containment_plan_has_no_pair_product(spark):
    docs = spark.createDataFrame([(1, "heat shock")], "doc_id long, text string")
    qs = spark.createDataFrame([(1, "heat"), (2, "a heat shock b")], "query_id long, query string")
    plan = judge.containment_qrels(qs, docs, materialize=False)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_negative_pairs_cut_walks_and_many_ring_buckets(spark, monkeypatch):
    judged = _judged(spark)
    want = rows(training.negative_pairs(judged, seed=42), "query_id", "doc_id", "query", "text", "label")
    monkeypatch.setattr(training, "_STEP_BLOCK", 3)
    monkeypatch.setattr(training, "_RING_BUCKET", 1)
    assert rows(training.negative_pairs(judged, seed=42), "query_id", "doc_id", "query", "text", "label") == want


def test_negative_ids_need_no_text(spark):
    out = training.negative_pairs(_judged(spark)).select("query_id", "doc_id")
    assert "text" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_negative_pairs_of_nothing(spark):
    assert training.negative_pairs(_judged(spark).limit(0)).count() == 0
