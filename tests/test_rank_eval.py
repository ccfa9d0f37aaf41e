import pytest
from pyspark.sql import functions as F

from rankfold.operators import evaluate as ev, rank
from conftest import rows


def _run(spark, items):
    return spark.createDataFrame(items, "query_id long, doc_id long, rnk int")


def test_rrf_golden(spark):
    # FIXTURES: list 1 = A, B; list 2 = B, C; k=60, 0-based, missing = 3
    a = _run(spark, [(1, 10, 1), (1, 11, 2)])     # A=10, B=11
    b = _run(spark, [(1, 11, 1), (1, 12, 2)])     # B=11, C=12
    got = {r["doc_id"]: (r["rank1"], r["rank2"], r["rerank"], r["rnk"]) for r in rank.rrf_two(a, b).collect()}
    assert got[11] == (1.0, 0.0, pytest.approx(0.033060109, abs=1e-9), 1)
    assert got[10] == (0.0, 3.0, pytest.approx(0.032539683, abs=1e-9), 2)
    assert got[12] == (3.0, 1.0, pytest.approx(0.032266458, abs=1e-9), 3)


def test_rrf_many_equals_two(spark):
    a = _run(spark, [(1, d, i + 1) for i, d in enumerate([5, 3, 9, 1])] + [(2, 7, 1)])
    b = _run(spark, [(1, d, i + 1) for i, d in enumerate([3, 4, 5])] + [(2, 8, 1), (2, 7, 2)])
    two = rows(rank.rrf_two(a, b), "query_id", "doc_id", "rerank", "rnk")
    many = rows(rank.rrf_many({"a": a, "b": b}), "query_id", "doc_id", "rerank", "rnk")
    assert two == many


def test_rrf_drop_rule(spark):
    a = _run(spark, [(1, 10, 1)])
    b = _run(spark, [(1, 11, 1)])
    got = dict(rows(rank.rrf_two(a, b, missing="drop", rank_base=1), "doc_id", "rerank"))
    assert got == {10: pytest.approx(1 / 61), 11: pytest.approx(1 / 61)}


def _curve(spark, rel, n_rel):
    flagged = spark.createDataFrame([(1, i + 100, i + 1, bool(x)) for i, x in enumerate(rel)],
                                    "query_id long, doc_id long, rnk int, relevant boolean")
    nr = spark.createDataFrame([(1, n_rel)], "query_id long, n_rel long")
    return [(r["top_k"], r["precision"], r["recall"], r["f1"])
            for r in ev.metric_curve(flagged, nr).orderBy("top_k").collect()]


def test_curve_golden(spark):
    # list 1 0 1 with one judged document missing -> n_rel = 3
    got = _curve(spark, [1, 0, 1], 3)
    want = [(1, 1.0, 0.333333, 0.5), (2, 0.5, 0.333333, 0.4), (3, 0.666667, 0.666667, 0.666667)]
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=1e-6)
    assert _curve(spark, [0, 0], 0) == [(1, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)]
    assert _curve(spark, [0, 1], 1) == [(1, 0.0, 0.0, 0.0), pytest.approx((2, 0.5, 1.0, 0.666667), abs=1e-6)]


def test_curve_properties(spark):
    rel = [1, 0, 0, 1, 1, 0, 1, 0, 0, 0, 1]
    got = _curve(spark, rel, 8)
    recalls = [r for _, _, r, _ in got]
    assert recalls == sorted(recalls)
    for k, p, _, _ in got:
        assert abs(p * k - round(p * k)) < 1e-6


def test_max_num_caps_curve(spark):
    flagged = spark.createDataFrame([(1, i, i, True) for i in range(1, 151)],
                                    "query_id long, doc_id long, rnk int, relevant boolean")
    nr = spark.createDataFrame([(1, 150)], "query_id long, n_rel long")
    assert ev.metric_curve(flagged, nr, max_num=100).count() == 100


def test_flag_and_summary(spark):
    run = _run(spark, [(1, 10, 1), (1, 11, 2), (1, 12, 3)])
    qrels = spark.createDataFrame([(1, 11), (1, 11), (1, 99)], "query_id long, doc_id long")
    flagged = ev.flag_relevant(run, qrels)
    assert rows(flagged, "doc_id", "relevant") == [(10, False), (11, True), (12, False)]
    s = ev.run_summary(flagged, ev.relevant_counts(qrels)).first()
    assert (s["n_answers"], s["n_rel"], s["n_retrieved_relevant"], s["n_missing"]) == (3, 2, 1, 1)
    assert rows(ev.missing_documents(run, qrels), "query_id", "doc_id") == [(1, 99)]
    more = qrels.unionByName(spark.createDataFrame([(2, 50)], "query_id long, doc_id long"))
    got = rows(ev.run_summary(ev.flag_relevant(run, more), ev.relevant_counts(more)),
               "query_id", "n_answers", "n_rel", "n_retrieved_relevant", "n_missing")
    assert got == [(1, 3, 2, 1, 1), (2, 0, 1, 0, 1)]


def test_mean_curve_counts_queries_reaching_rank(spark):
    curve = spark.createDataFrame([(1, 1, 1.0, 1.0, 1.0), (1, 2, 0.5, 1.0, 0.6), (2, 1, 0.0, 0.0, 0.0)],
                                  "query_id long, top_k int, precision double, recall double, f1 double")
    got = {r["top_k"]: (r["n_queries"], r["precision"]) for r in ev.mean_curve(curve).collect()}
    assert got == {1: (2, 0.5), 2: (1, 0.5)}


def test_label_judgements_exclude_self(spark):
    q = spark.createDataFrame([(1, [0.0], 7)], "query_id long, embedding array<float>, label int")
    d = spark.createDataFrame([(1, [0.0], 7), (2, [1.0], 7), (3, [2.0], 8)], "doc_id long, embedding array<float>, label int")
    run = _run(spark, [(1, 2, 1), (1, 3, 2)])
    flagged, n_rel = ev.flag_by_label(run, q, d)
    assert n_rel.first()["n_rel"] == 1
    assert rows(flagged, "doc_id", "relevant") == [(2, True), (3, False)]


def test_label_judgements_move_a_run_once(spark, monkeypatch):
    q = spark.createDataFrame([(i, i % 3) for i in range(9)] + [(4, 2), (8, None)], "query_id long, label int")
    run = _run(spark, [(i, j, r) for i in range(9) for r, j in enumerate((i + 1, i + 2, i + 5), 1)])
    d = q.withColumnRenamed("query_id", "doc_id")
    cols = "query_id", "doc_id", "rnk", "relevant"
    key = lambda r: tuple(str(x) for x in r)
    flagged, _ = ev.flag_by_label(run, q, d)
    got = sorted((tuple(r) for r in flagged.select(*cols).collect()), key=key)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(ev, "LABEL_BYTES", 0)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged, _ = ev.flag_by_label(run, q, d)
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2 and plan.count("hashpartitioning(query_id") == 2
        assert sorted((tuple(r) for r in flagged.select(*cols).collect()), key=key) == got and len(got) == 26
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_attach_adds_only_missing_columns(spark):
    run = _run(spark, [(1, 10, 1), (1, 11, 2)])
    qrels = spark.createDataFrame([(1, 11)], "query_id long, doc_id long")
    corpus = spark.createDataFrame([(10, "a"), (11, "b"), (11, "b")], "doc_id long, text string")
    out = ev.attach(run, qrels, corpus)
    assert rows(out, "doc_id", "relevant", "text") == [(10, False, "a"), (11, True, "b")]
    pre = run.withColumn("relevant", F.lit(True))
    assert rows(ev.attach(pre, qrels, corpus), "doc_id", "relevant") == [(10, True), (11, True)]
    assert run.columns == ["query_id", "doc_id", "rnk"]
