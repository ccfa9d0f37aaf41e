import math
import random
import re
from collections import Counter

import pytest

from rankfold.llm import reversed_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n int, doc string, terms int, score string"
ITEMS = "item_id long, text string, item int, qtf int, term string"


def cut(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    counts = [(d, Counter(cut(t))) for d, t in docs if cut(t)]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    smallest = {}
    for i, t in items:
        if t is not None and (i not in smallest or t < smallest[i]):
            smallest[i] = t
    out = []
    for item, text in smallest.items():
        scored = []
        for d, c in counts:
            n, score = sum(c.values()), 0
            m = 100 - 25 + (25 * n * n_docs) // total
            for t, q in Counter(cut(text)).items():
                df = sum(t in other for _, other in counts)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += q * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    words = ["a", "b9", "Été", "ÉTÉ", "straße", "of", "THE", "x1", "日本", "naïve", "z", "q"]
    docs = [(i, " ,.-".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(120)]
    docs += [(500, None), (501, ""), (None, "a b9 the"), (None, "a b9 the"), (502, "a b9 the"), (502, "a b9 the"), (503, "of " * 30_000),
             (504, " \t\n_@[`{\x7f")]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(7)]
    items += [(8, None), (9, ""), (None, "z q"), (3, "a"), (3, "a"), (10, "unknown"), (11, "The the A")]
    return docs, items


@pytest.mark.parametrize("block_items", [R.BLOCK_ITEMS, 2])
def test_equals_brute_force(spark, tables, block_items):
    docs, items = tables
    d = spark.createDataFrame([(*r, 1, "x", 2, "s") for r in docs], DOCS).repartition(5)
    i = spark.createDataFrame([(*r, 1, 2, "t") for r in items], ITEMS)
    got = R.search(d, i, block_items=block_items)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    assert sorted(map(tuple, R.search(d, i, k=3).collect()), key=str) == brute(docs, items, 3)


def test_documents_in_slices(spark, tables, monkeypatch):
    docs, items = tables
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, R.op12(d, i).collect()), key=str)
    monkeypatch.setattr(R, "_CELLS", 30)
    assert sorted(map(tuple, R.op12(d, i).collect()), key=str) == want


def test_no_rows(spark, tables):
    docs, items = tables
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    none_d, none_i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    for found in (R.op12(none_d, i), R.op12(d, none_i), R.op12(none_d, none_i)):
        assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]


def test_text_keys(spark):
    d = spark.createDataFrame([(1, "one two"), (2, "two")], "doc_id long, text string")
    i = spark.createDataFrame([("k", "two")], "item_id string, text string")
    assert [tuple(r)[:3] for r in R.op12(d, i).orderBy("rank").collect()] == [("k", 1, 2), ("k", 2, 1)]
