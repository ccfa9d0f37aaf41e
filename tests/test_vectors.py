import numpy as np
import pytest

from rankfold.operators import vectors
from conftest import rows


def _q(spark, items):
    return spark.createDataFrame(items, "query_id long, embedding array<float>")


def _d(spark, items):
    return spark.createDataFrame(items, "doc_id long, embedding array<float>")


def test_squared_l2_golden(spark):
    q = _q(spark, [(1, [0.0, 0.0])])
    d = _d(spark, [(10, [1.0, 0.0]), (11, [0.0, 2.0]), (12, [3.0, 4.0])])
    got = rows(vectors.knn_search(q, d, k=3), "doc_id", "score", "rnk")
    assert got == [(10, 1.0, 1), (11, 4.0, 2), (12, 25.0, 3)]
    got = rows(vectors.knn_search(q, d, k=3, squared=False), "doc_id", "score")
    assert got == [(10, 1.0), (11, 2.0), (12, 5.0)]


def test_ties_break_by_doc_id_and_k_larger_than_corpus(spark):
    q = _q(spark, [(1, [0.0])])
    d = _d(spark, [(12, [1.0]), (10, [-1.0]), (11, [1.0])])
    assert rows(vectors.knn_search(q, d, k=10), "rnk", "doc_id") == [(1, 10), (2, 11), (3, 12)]


def _random(spark, n_q, n_d, dim, seed=7):
    rng = np.random.default_rng(seed)
    Q = rng.normal(size=(n_q, dim)).astype(np.float32)
    D = rng.normal(size=(n_d, dim)).astype(np.float32)
    D /= np.linalg.norm(D, axis=1, keepdims=True)
    Q /= np.linalg.norm(Q, axis=1, keepdims=True)
    q = _q(spark, [(i, Q[i].tolist()) for i in range(n_q)])
    d = _d(spark, [(1000 + j, D[j].tolist()) for j in range(n_d)]).repartition(5)
    return Q.astype(np.float64), D.astype(np.float64), q, d


def test_matches_brute_force_and_strategies_agree(spark):
    Q, D, q, d = _random(spark, 13, 300, 16)
    full = ((Q[:, None, :] - D[None, :, :]) ** 2).sum(-1)
    want = sorted((i, 1000 + int(j)) for i in range(len(Q)) for j in np.argsort(full[i], kind="stable")[:5])
    b = rows(vectors.knn_search(q, d, k=5, strategy="broadcast"), "query_id", "doc_id")
    g = rows(vectors.knn_search(q, d, k=5, strategy="grid"), "query_id", "doc_id")
    assert b == want and g == want


def test_cosine_order_equals_l2_on_unit_vectors(spark):
    _, _, q, d = _random(spark, 6, 120, 8, seed=3)
    a = rows(vectors.knn_search(q, d, k=7), "query_id", "doc_id", "rnk")
    c = rows(vectors.knn_search(q, d, k=7, metric="cosine"), "query_id", "doc_id", "rnk")
    assert a == c


def test_exclude_self(spark):
    q = _q(spark, [(1, [0.0]), (2, [5.0])])
    d = _d(spark, [(1, [0.0]), (2, [5.0]), (3, [1.0])])
    got = rows(vectors.knn_search(q, d, k=1, exclude_self=True), "query_id", "doc_id")
    assert got == [(1, 3), (2, 3)]


def test_zero_vector_cosine(spark):
    q = _q(spark, [(1, [0.0, 0.0])])
    d = _d(spark, [(10, [1.0, 0.0])])
    assert rows(vectors.knn_search(q, d, k=1, metric="cosine"), "doc_id", "score") == [(10, 0.0)]


def test_unequal_lengths_fail(spark):
    q = _q(spark, [(1, [0.0, 0.0])])
    d = _d(spark, [(10, [1.0, 0.0, 3.0])])
    with pytest.raises(Exception, match="length"):
        vectors.knn_search(q, d, k=1).collect()


def test_plan_has_no_pair_rows(spark):
    _, _, q, d = _random(spark, 4, 50, 4)
    plan = vectors.knn_search(q, d, k=3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


def test_task_emits_at_most_k_rows_a_query(spark):
    Q, D, q, d = _random(spark, 11, 240, 8, seed=5)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(size)
    spark.conf.set(size, "20")
    try:
        part = vectors._broadcast_search(q, d.coalesce(1), 4, "l2", True, False, 6, None)
        assert part.count() == 11 * 4
        for metric in ("l2", "cosine"):
            a = rows(vectors.knn_search(q, d.coalesce(1), k=4, metric=metric), "query_id", "doc_id", "rnk", "score")
            b = rows(vectors.knn_search(q, d, k=4, metric=metric, strategy="grid", query_block=4, doc_block=50),
                     "query_id", "doc_id", "rnk", "score")
            assert a == b
    finally:
        spark.conf.set(size, old)


def test_broadcast_is_checked_in_bytes(spark):
    _, _, q, d = _random(spark, 30, 40, 8)
    with pytest.raises(ValueError, match="broadcast bound"):
        vectors.knn_search(q, d, k=2, strategy="broadcast", max_broadcast_bytes=500)
    a = rows(vectors.knn_search(q, d, k=2, max_broadcast_bytes=500, min_blocks=2), "query_id", "doc_id", "rnk")
    assert a == rows(vectors.knn_search(q, d, k=2), "query_id", "doc_id", "rnk")


def _brute(qids, Q, dids, D, k, metric, squared, exclude_self):
    out = {}
    with np.errstate(invalid="ignore", divide="ignore"):
        for i, x in zip(qids, Q):
            if metric == "cosine":
                norm = np.sqrt((x * x).sum()) * np.sqrt((D * D).sum(1))
                score = np.where(norm > 0, (D @ x) / norm, 0.0)
                score = np.where(np.isfinite(D).all(1), score, np.nan)
            else:
                score = ((D - x) ** 2).sum(1)
                score = score if squared else np.sqrt(score)
            score = np.round(score, 6)
            key = -score if metric == "cosine" else score
            ranked = sorted((key[j], d, score[j]) for j, d in enumerate(dids) if np.isfinite(score[j]) and not (exclude_self and d == i))
            out[int(i)] = [(int(d), float(s) + 0.0) for _, d, s in ranked[:k]]
    return out


@pytest.mark.parametrize("metric, squared", [("l2", True), ("l2", False), ("cosine", True)])
def test_tiles_give_the_brute_force_answers(monkeypatch, metric, squared):
    for name, size in (("TILE_ROWS", 3), ("TILE_COLS", 5), ("_CANDIDATES", 7)):
        monkeypatch.setattr(vectors, name, size)
    rng = np.random.default_rng(4)
    for k in (1, 4, 90):
        D = rng.integers(-2, 3, size=(60, 3)) * 0.7  # many equal vectors and distances, some zero vectors
        D[7, 1] = np.nan
        dids, qids = rng.permutation(60), np.arange(20)
        Q = rng.integers(-2, 3, size=(20, 3)) * 0.7
        for exclude in (False, True):
            got = {int(i): [] for i in qids}
            for q, d, s in vectors._block_top_k(qids, Q, dids, D, k, metric, squared, exclude, 6):
                for a, b, c in zip(q, d, s):
                    got[int(a)].append((int(b), float(c) + 0.0))
            assert got == _brute(qids, Q, dids, D, k, metric, squared, exclude)


def test_memory_of_a_block_is_bounded_on_equal_vectors():
    import tracemalloc

    D = np.tile(np.linspace(0.0, 1.0, 64), (2_000, 1))
    ids = np.arange(2_000)
    tracemalloc.start()
    parts = vectors._block_top_k(ids, D, ids, D, 3, "l2", True, False, 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(p[0]) for p in parts) == 6_000 and all((p[1] < 3).all() for p in parts)
    assert peak < 250e6


def test_many_answers_are_searched_in_blocks(spark, monkeypatch):
    _, _, q, d = _random(spark, 30, 40, 8)
    want = rows(vectors.knn_search(q, d, k=4, strategy="broadcast"), "query_id", "doc_id", "rnk", "score")
    monkeypatch.setattr(vectors, "MAX_BROADCAST_ANSWERS", 100)
    found = vectors.knn_search(q, d, k=4)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found, "query_id", "doc_id", "rnk", "score") == want
    assert "FlatMapCoGroupsInArrow" not in vectors.knn_search(q, d, k=3)._jdf.queryExecution().executedPlan().toString()


def test_blocks_meet_in_whatever_partitions(spark):
    _, _, q, d = _random(spark, 40, 60, 8)
    want = rows(vectors.knn_search(q, d, k=4, strategy="broadcast"), "query_id", "doc_id", "rnk", "score")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        assert rows(vectors.knn_search(q, d, k=4, strategy="grid", query_block=10, doc_block=20), "query_id", "doc_id", "rnk", "score") == want
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def _streamed(spark, monkeypatch, ids):
    """Repeated ids, equal vectors and several tiles and blocks of queries."""
    for name, size in (("TILE_ROWS", 9), ("STREAM_QUERIES", 60), ("STREAM_LEAST", 16)):
        monkeypatch.setattr(vectors, name, size)
    rng = np.random.default_rng(3)
    V = (rng.integers(-2, 3, size=(200, 4)) * 0.7).astype(np.float32)
    own = [ids(int(i)) for i in rng.integers(0, 150, size=200)]
    kind = "string" if isinstance(own[0], str) else "long"
    items = [(i, v.tolist()) for i, v in zip(own, V)]
    return (spark.createDataFrame(items, f"query_id {kind}, embedding array<float>").repartition(3),
            spark.createDataFrame(items, f"doc_id {kind}, embedding array<float>").repartition(5))


@pytest.mark.parametrize("ids", [int, str])
def test_stream_gives_the_answers_of_broadcast(spark, monkeypatch, ids):
    q, d = _streamed(spark, monkeypatch, ids)
    cols = "query_id", "doc_id", "score", "rnk"
    for metric, squared, k, exclude in (("l2", True, 7, True), ("l2", False, 1, False), ("cosine", True, 300, True)):
        kw = dict(k=k, metric=metric, squared=squared, exclude_self=exclude)
        want = rows(vectors.knn_search(q, d, strategy="broadcast", **kw), *cols)
        assert rows(vectors.knn_search(q, d, strategy="stream", **kw), *cols) == want
        monkeypatch.setattr(vectors, "STREAM_LEAST", 200)  # one block of queries: blocks of documents as well
        assert rows(vectors.knn_search(q, d, strategy="stream", doc_block=40, **kw), *cols) == want
        monkeypatch.setattr(vectors, "STREAM_LEAST", 16)


def test_lists_of_many_answers_over_many_documents_are_not_merged(spark, monkeypatch):
    q, d = _streamed(spark, monkeypatch, int)
    want = rows(vectors.knn_search(q, d, k=4), "query_id", "doc_id", "rnk", "score")
    monkeypatch.setattr(vectors, "MAX_BROADCAST_ANSWERS", 100)
    found = vectors.knn_search(q, d, k=4, doc_block=60)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroups" not in plan and "Window" not in plan
    assert "ENSURE_REQUIREMENTS" not in plan
    assert rows(found, "query_id", "doc_id", "rnk", "score") == want


def test_blocks_of_the_stream():
    assert vectors._stream_blocks(600_000, 600_000, 100, 6, 65_536) == (24, 1)
    assert vectors._stream_blocks(6_000, 10_000_000, 100, 6, 65_536) == (2, 3)
    assert vectors._stream_blocks(600_000, 600_000, 100_000, 6, 65_536)[0] >= 15_000
    assert vectors._stream_blocks(0, 0, 10, 6, 65_536) == (1, 1)


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_tile_values_are_lower_bounds(metric):
    rng = np.random.default_rng(8)
    scale = 10.0 ** rng.uniform(-6, 6, size=(300, 1))
    x, y = (rng.normal(size=(300, 64)) * scale).astype(np.float32).astype(np.float64), rng.normal(size=(200, 64))
    y[:100] = x[:100] * (1 + 1e-6)  # near copies: the terms cancel
    for kind in (np.float32, np.float64):
        sides = (vectors._side(v, (v * v).sum(1), metric, kind, query) for v, query in ((x, True), (y, False)))
        got = np.matmul(next(sides), next(sides).T).astype(np.float64)
        if metric == "cosine":
            true = -(x @ y.T) / np.sqrt((x * x).sum(1))[:, None] / np.sqrt((y * y).sum(1))
            scale = 1.0
        else:
            true = np.square(x[:, None, :] - y[None, :, :]).sum(-1)
            scale = (x * x).sum(1)[:, None] + (y * y).sum(1)
        assert (got <= true).all() and (true <= got + 2 * vectors._slack(64, kind) * scale).all()


@pytest.mark.parametrize("metric, squared", [("l2", True), ("l2", False), ("cosine", True)])
def test_vectors_of_very_different_lengths_get_exact_answers(monkeypatch, metric, squared):
    monkeypatch.setattr(vectors, "TILE_COLS", 16)
    rng = np.random.default_rng(9)
    D = rng.normal(size=(90, 8)) * 10.0 ** rng.integers(-3, 4, size=(90, 1))
    D[3], D[40], D[41] = 1e17, 0.0, np.inf  # beyond float32's products, zero, not finite
    ids = np.arange(90)
    got = {int(i): [] for i in ids}
    for q, d, s in vectors._block_top_k(ids, D, ids, D, 5, metric, squared, True, 6):
        for a, b, c in zip(q, d, s):
            got[int(a)].append((int(b), float(c) + 0.0))
    want = _brute(ids, D, ids, D, 5, metric, squared, True)
    assert {i: [x for x, _ in got[i]] for i in got if i not in (3, 41)} == {i: [x for x, _ in want[i]] for i in want if i not in (3, 41)}
    assert got[41] == [] and len(got[3]) == 5
