import numpy as np
import pytest

from rankfold.llm import mih


def block(kind, n=8192, dim=64, seed=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    return x if kind == "isotropic" else rng.normal(size=(40, dim))[rng.integers(0, 40, n)] + 0.5 * x


def test_substrings_are_the_bits():
    x = block("isotropic", 50, 16)
    model = mih.learn(x, 35)
    bits = (x / np.linalg.norm(x, axis=1, keepdims=True) - model[0]) @ model[1] > 0
    codes = mih.encode(x, model, 7)
    for row, code in zip(bits, codes):
        assert code.tolist() == [sum(int(b) << i for i, b in enumerate(part)) for part in row.reshape(5, 7)]


def test_rounds_meet_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    length, m = 9, 4
    codes = rng.integers(0, 1 << length, (700, m)).astype(np.uint16)
    index = mih.MultiIndex(codes, length)
    for q in range(5):
        d = mih.POPCOUNT[codes ^ codes[q]].sum(1)
        distance = np.full(700, -1, np.int16)
        for w in range(length + 1):
            index.probe(codes[q], w, distance)
            met = distance >= 0
            assert met[d <= m * (w + 1) - 1].all() and (distance[met] == d[met]).all()
        assert met.all()
        for w, rows, dist in index.rounds(codes[q], 40):
            assert len(set(rows)) == len(rows) and (dist == d[rows]).all()


def test_reach_is_a_probability():
    length, m = 10, 6
    rng = np.random.default_rng(5)
    for w in range(4):
        h = mih.reach(w, length, m, 0.95)
        flips = np.array([rng.permutation(length * m) < h for _ in range(4000)]).reshape(4000, m, length).sum(2)
        assert (flips.min(1) <= w).mean() >= 0.94


@pytest.mark.parametrize("kind, most", [("isotropic", 1.0), ("clustered", 0.3)])
def test_recall_and_entries_read_in_a_full_block(kind, most):
    x = block(kind, mih.BLOCK_VECTORS)
    length, m = mih.layout(len(x))
    model = mih.learn(x[::2], length * m)
    index = mih.MultiIndex(mih.encode(x, model, length), length)
    asked = np.arange(0, len(x), 100)
    got = mih.search_block([[i] for i in range(len(x))], x, asked.tolist(), x[asked], model, 5, mih.NEAR, length, index=index)
    u, by = x / np.linalg.norm(x, axis=1, keepdims=True), {}
    for q, i, score in got:
        assert abs(score - u[q] @ u[i]) < 1e-12
        by.setdefault(q, set()).add(i)
    hit = 0
    for q in asked:
        c = u @ u[q]
        c[q] = -2
        hit += len(by[q] & set(np.argsort(-c)[:5].tolist()))
    assert hit / (5 * len(asked)) >= 0.9
    assert index.read < most * len(asked) * len(x)  # a scan reads every code for every query


def test_several_full_blocks(spark):
    n = 3 * mih.BLOCK_VECTORS
    x = block("clustered", n, 16, 9)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(8)
    u, hit, by = x / np.linalg.norm(x, axis=1, keepdims=True), 0, {}
    for r in mih.search(df, df.where("id % 400 = 0")).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    for q in by:
        c = u @ u[q]
        c[q] = -2
        hit += len(by[q] & set(np.argsort(-c)[:5].tolist()))
    assert len(by) == -(-n // 400) and hit / (5 * len(by)) >= 0.9
