import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from rankfold.operators import vector_store, vectors


def _table(spark, ids, x, name):
    kind = "string" if isinstance(ids[0], str) else "long"
    return spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], f"{name} {kind}, embedding array<float>")


def _clusters(n, dim=8, centres=6, seed=1, spread=0.05):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return (c[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, dim))).astype(np.float32)


@pytest.fixture(scope="module")
def world(spark):
    x = _clusters(600)
    d = _table(spark, list(range(600)), x, "doc_id").repartition(4)
    q = _table(spark, list(range(0, 600, 20)), x[::20], "query_id")
    return x, d, q


def _answers(df):
    return rows(df, "query_id", "rnk", "doc_id", "score")


@pytest.mark.parametrize("metric, squared, exclude", [("l2", True, False), ("l2", False, True), ("cosine", True, True)])
def test_cells_give_the_exact_answers(world, metric, squared, exclude):
    _, d, q = world
    want = _answers(vectors.knn_search(q, d, 7, metric, squared, exclude, strategy="broadcast"))
    store = vector_store.create(d, metric=metric, n_cells=12)
    store.append(d, 0)
    assert _answers(store.search(q, 7, squared, exclude)) == want
    assert _answers(store.search(q, 7, squared, exclude, query_block=5, doc_block=17)) == want
    assert _answers(vectors.knn_search(q, d, 7, metric, squared, exclude, max_broadcast_bytes=1)) == want


def test_isotropic_vectors_ties_and_large_k(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-2, 3, size=(200, 3)).astype(np.float32)  # many ties, some zero vectors
    d, q = _table(spark, list(range(200)), x, "doc_id"), _table(spark, list(range(40)), x[:40], "query_id")
    for metric in ("l2", "cosine"):
        store = vector_store.create(d, metric=metric, n_cells=9)
        store.append(d, 0)
        for k in (1, 5, 500):
            assert _answers(store.search(q, k)) == _answers(vectors.knn_search(q, d, k, metric, strategy="broadcast"))


def test_cells_no_query_needs_are_not_read(spark, world):
    x, d, _ = world
    store = vector_store.create(d, n_cells=12)
    store.append(d, 0)
    q = _table(spark, [0], x[:1], "query_id")
    centres, cells = store.centres(), store.cells().orderBy("cell_id").toArrow()
    table = tuple(cells.column(c).to_numpy() for c in ("cell_id", "n", "lo", "hi"))
    home = store._wanted(q, centres, table, True, 5)
    assert home.count() < cells.num_rows
    ddl = vectors.answer_ddl(q, store.vectors())
    found = store._search_cells(home, store.needed(home, 100, 100), ddl, 5, "l2", True, False, 6)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    read = store.vectors().join(F.broadcast(store.needed(home, 100, 100).where("queries > 0")), "cell_id")
    assert read.count() < d.count()
    reach = q.withColumn("reach", F.lit(0.3))
    assert store._wanted(reach, centres, table, False, 5).count() + home.count() < cells.num_rows


def test_appends_are_idempotent_and_become_visible_by_their_commit(spark, world, tmp_path):
    x, d, q = world
    store = vector_store.create(d, str(tmp_path / "store"), n_cells=10)
    a, b = d.where("doc_id < 200"), d.where("doc_id >= 150 AND doc_id < 420")
    assert store.append(a, 0) == 200
    before = _answers(store.search(q, 5))
    pinned = store.pinned()
    assert store.append(b, 1, commit=False) == 220
    assert store.count() == 200 and _answers(store.search(q, 5)) == before
    store.commit(1, 220)
    assert store.append(b, 1) == 220  # replayed
    assert store.append(a, 0) == 200
    assert store.append(d.where("doc_id < 420"), 7) == 0  # known ids under a new batch
    assert store.append(d.where("doc_id >= 400"), 2) == 180
    assert rows(store.vectors(), "doc_id") == [(i,) for i in range(600)] and store.count() == 600
    want = _answers(vectors.knn_search(q, d, 5, strategy="broadcast"))
    again = vector_store.VectorStore(spark, str(tmp_path / "store"))
    assert _answers(again.search(q, 5)) == want
    assert _answers(pinned.search(q, 5)) == before


def test_ids_may_be_strings(spark):
    x = _clusters(90, seed=4)
    names = [f"doc-{i:03d}" for i in range(90)]
    d, q = _table(spark, names, x, "doc_id"), _table(spark, [f"q{i}" for i in range(9)], x[:9], "query_id")
    store = vector_store.create(d, n_cells=5)
    store.append(d, 0)
    want = _answers(vectors.knn_search(q, d, 4, strategy="broadcast"))
    assert isinstance(want[0][2], str) and _answers(store.search(q, 4)) == want
    assert _answers(vectors.knn_search(q, d, 4, strategy="grid", min_blocks=2)) == want


def test_hot_cell_is_many_tasks(spark):
    x = np.vstack([np.zeros((500, 4)), _clusters(100, 4)]).astype(np.float32)
    d, q = _table(spark, list(range(600)), x, "doc_id"), _table(spark, [0, 550], x[[0, 550]], "query_id")
    store = vector_store.create(d, n_cells=6)
    store.append(d, 0)
    hot = store.needed(store._wanted(q, store.centres(), tuple(store.cells().orderBy("cell_id").toArrow().column(c).to_numpy()
                                                                 for c in ("cell_id", "n", "lo", "hi")), True, 3), 10, 50)
    assert max(r.doc_blocks for r in hot.collect()) >= 10
    assert _answers(store.search(q, 3, doc_block=50)) == _answers(vectors.knn_search(q, d, 3, strategy="broadcast"))


def test_empty_store(spark):
    store = vector_store.VectorStore(spark, "/nowhere/at/all")
    assert store.committed() == () and store.count() == 0
    with pytest.raises(ValueError, match="no committed batch"):
        store.vectors()
    none = spark.createDataFrame([], "doc_id long, embedding array<float>")
    with pytest.raises(ValueError, match="no vectors"):
        vector_store.create(none)
    q = _table(spark, [1], np.ones((1, 2), np.float32), "query_id")
    assert vectors.knn_search(q, none, 3, max_broadcast_bytes=1).count() == 0


def test_queries_travel_once_to_a_group_of_cells(spark):
    x = np.random.default_rng(3).normal(size=(300, 16)).astype(np.float32)  # no clusters: every query needs every cell
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d, q = _table(spark, list(range(300)), x, "doc_id"), _table(spark, list(range(300)), x, "query_id")
    store = vector_store.create(d, n_cells=100)
    store.append(d, 0)
    cells = store.cells().orderBy("cell_id").toArrow()
    table = tuple(cells.column(c).to_numpy() for c in ("cell_id", "n", "lo", "hi"))
    groups = vector_store.group_cells(store.centres()[table[0]], table[1], 1_000)
    assert groups[0].max() == 1 and groups[1].max() < vector_store.GROUP_CELLS
    assert np.bincount(groups[0]).sum() == len(table[0]) > 63 and len(set(zip(*groups))) == len(table[0])
    far = q.withColumn("reach", F.lit(float("inf"))).withColumn("last", F.lit(None).cast("double"))
    assert store._asked(far, store.centres(), table, groups, 2).count() == 600
    want = _answers(vectors.knn_search(q, d, 6, exclude_self=True, strategy="broadcast"))
    assert _answers(store.search(q, 6, exclude_self=True)) == want
    assert _answers(store.search(q, 6, exclude_self=True, query_block=70, doc_block=40)) == want


def test_rows_of_wanted_cells_leave_in_bounded_batches(spark, monkeypatch):
    x = np.random.default_rng(5).normal(size=(2_000, 4)).astype(np.float32)
    d, q = _table(spark, list(range(2_000)), x, "doc_id"), _table(spark, list(range(2_000)), x, "query_id").coalesce(1)
    store = vector_store.create(d, n_cells=20)
    store.append(d, 0)
    sizes = []
    monkeypatch.setattr(vector_store, "_cells_of", lambda x, *a, real=vector_store._cells_of: sizes.append(len(x)) or real(x, *a))

    class Mapped:
        """Runs what the search maps over Arrow batches here, to see its batches."""
        schema, sparkSession = q.schema, spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            sizes.extend(b.num_rows // 20 for b in run(iter(q.toArrow().to_batches())))
            return q

    monkeypatch.setattr(vector_store, "materialize", lambda df, _: df)
    cells = store.cells().orderBy("cell_id").toArrow()
    store._wanted(Mapped(), store.centres(), tuple(cells.column(c).to_numpy() for c in ("cell_id", "n", "lo", "hi")), True, 10_000)
    assert sizes and max(sizes) <= vectors.TILE_ROWS
