import hashlib
import math
import zlib
from collections import Counter

import pytest

from rankfold.llm import hash_tree as H

DOCS = "doc_id long, text string, shard string, slot int, place string, copies int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"text {i}", "x", 1, "p", 2) for i in range(400)]
    rows += [(None, "no id", "x", 1, "p", 2)] * 3 + [(7, None, None, None, None, None), (8, "", None, None, None, None)]
    rows += [(9, "word " * 40_000, "x", 1, "p", 2)] + [(10, "same", "x", 1, "p", 2)] * 300
    return spark.createDataFrame(rows, DOCS)


def descended(key, tree):
    """The same descent, one row at a time."""
    nodes, path, children = tree.children()[""], "", tree.children()
    while True:
        def score(node):
            u = (int(hashlib.md5(f"{H.SEED}:{node[0]}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
            return -math.log(u) / node[1], node[0]
        path, _, shard = min(nodes, key=score)
        if shard >= 0:
            return path, shard
        nodes = children[path]


def test_rows_by_brute_force(odd):
    got = H.op11(odd).collect()
    want = Counter()
    for r in odd.collect():
        key = "null" if r.doc_id is None else str(r.doc_id)
        path, shard = descended(key, H.TREE)
        data = (r.text or "").encode()
        want[(r.doc_id, len(data) + 1, zlib.crc32(data), "key", shard, descended(key, H.grown(H.TREE))[1], *path.split("/")[:2])] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard, r.region, r.rack) for r in got) == want
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


@pytest.mark.parametrize("bucket_rows", [1, 7, 100_000])
def test_slots_do_not_depend_on_buckets(odd, bucket_rows):
    x = H.place(odd.select("doc_id", "text"), H.TREE).selectExpr("doc_id", "crc32(text) AS crc", "shard.shard AS s")
    a = {tuple(r) for r in H.slots(x, "s", ["doc_id", "crc"], bucket_rows=bucket_rows).collect()}
    assert a == {tuple(r) for r in H.slots(x, "s", ["doc_id", "crc"]).collect()} and len(a) == odd.count()


def test_one_more_shard_takes_rows_only_into_itself(spark):
    x = H.op11(spark.range(20_000).selectExpr("id AS doc_id", "'t' AS text")).collect()
    assert {r.grown_shard for r in x if r.shard != r.grown_shard} == {8}
    for shard, n in Counter(r.shard for r in x).items():
        assert abs(n - 2500) < 250, shard
    for shard, n in Counter(r.grown_shard for r in x).items():
        assert abs(n - 20_000 / 9) < 250, shard


def test_weights_and_confined_movement(spark):
    x = spark.range(12_000).selectExpr("id AS doc_id")
    place = lambda tree: {r.doc_id: r.shard.path for r in H.place(x, tree).collect()}
    before = place(H.TREE)
    held = place(H.reweighted(H.TREE, 1, 3.0, hold=True))
    moved = [(before[i], held[i]) for i in before if before[i] != held[i]]
    assert moved and all(a.startswith("a/r0/") and b == "a/r0/1" for a, b in moved)
    free = place(H.reweighted(H.TREE, 1, 3.0))
    moved = [(before[i], free[i]) for i in before if before[i] != free[i]]
    assert all(b.startswith("a/") for _, b in moved)  # only the region whose weight rose takes rows
    assert all(b.startswith("a/r0/") for a, b in moved if a.startswith("a/"))
    assert abs(sum(p == "a/r0/1" for p in free.values()) / 12_000 - 0.3) < 0.03
    gone = place(H.reweighted(H.TREE, 7, 0.0))
    assert not any(p == "b/r1/7" for p in gone.values())
    assert all(before[i] == "b/r1/7" or before[i].startswith("b/") for i in before if before[i] != gone[i])


def test_bad_trees_and_no_rows(spark):
    with pytest.raises(ValueError):
        H.Tree({"a": {"r": {0: 1.0}}, "b": {"r": {0: 1.0}}})
    with pytest.raises(ValueError):
        H.Tree({"a": {"r": {0: 0.0}}})
    with pytest.raises(ValueError):
        H.Tree({"a": {"r": {0: -1.0}}})
    assert H.op11(spark.createDataFrame([], DOCS)).count() == 0


def test_no_python_in_the_plan(odd):
    plan = H.op11(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
