"""Seeded random fixtures checked against direct Python computations."""

import math
import random
import re

import pytest

from rankfold.functions.text import STOP_WORDS
from rankfold.operators import evaluate as ev, lexical

VOCAB = ["flow", "heat", "wing", "shock", "wave", "the", "of", "drag", "lift", "mach", "x", "ÉLAN", "élan"]


def _terms(text):
    stops = set(STOP_WORDS)
    return [t for t in re.findall(r"[^\W]{2,}", text.lower()) if t not in stops]


def _bm25_reference(docs, queries, k1=1.5, b=0.75):
    toks = {d: _terms(t) for d, t in docs}
    n = len(docs)
    avgdl = sum(len(t) for t in toks.values()) / n
    df = {}
    for t in toks.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = {}
    for q, text in queries:
        for d, t in toks.items():
            s, hit = 0.0, False
            for w in _terms(text):
                tf = t.count(w)
                if tf:
                    hit = True
                    idf = math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                    s += idf * tf / (tf + k1 * (1 - b + b * len(t) / avgdl))
            if hit:
                out[(q, d)] = round(s, 6)
    return out


def test_bm25_matches_direct_formula(spark):
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    queries = [(j, " ".join(rng.choice(VOCAB) for _ in range(rng.randint(1, 4)))) for j in range(15)]
    ddf = spark.createDataFrame(docs, "doc_id long, text string")
    qdf = spark.createDataFrame(queries, "query_id long, query string")
    want = _bm25_reference(docs, queries)
    got = {(r["query_id"], r["doc_id"]): r["score"]
           for r in lexical.bm25_search(qdf, lexical.build_index(ddf), k=1000).collect()}
    assert set(got) == set(want)
    assert got == pytest.approx(want, abs=2e-6)
    top3 = lexical.bm25_search(qdf, lexical.build_index(ddf), k=3).collect()
    for r in top3:
        ranked = sorted(((-s, d) for (q, d), s in want.items() if q == r["query_id"]))
        assert (-ranked[r["rnk"] - 1][0], ranked[r["rnk"] - 1][1]) == pytest.approx((r["score"], r["doc_id"]))


def _curve_reference(rel, missing, max_num=100):
    """The reference's definition: for every cut-off, rescan the top of the list."""
    rows = []
    for k in range(min(max_num, len(rel))):
        top = rel[: k + 1]
        tp = sum(top)
        fn = sum(rel) + missing - tp
        p = tp / (k + 1)
        r = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * p * r / (p + r) if p + r else 0.0
        rows.append((k + 1, p, r, f1))
    return rows


def test_curve_matches_rescan_definition(spark):
    rng = random.Random(5)
    lists = {q: ([rng.random() < 0.3 for _ in range(rng.randint(1, 130))], rng.randint(0, 4)) for q in range(40)}
    flagged = spark.createDataFrame(
        [(q, 1000 + i, i + 1, rel) for q, (lst, _) in lists.items() for i, rel in enumerate(lst)],
        "query_id long, doc_id long, rnk int, relevant boolean")
    n_rel = spark.createDataFrame([(q, sum(lst) + m) for q, (lst, m) in lists.items()], "query_id long, n_rel long")
    got = {}
    for r in ev.metric_curve(flagged, n_rel).collect():
        got.setdefault(r["query_id"], []).append((r["top_k"], r["precision"], r["recall"], r["f1"]))
    for q, (lst, m) in lists.items():
        want = _curve_reference([int(x) for x in lst], m)
        have = sorted(got[q])
        assert len(have) == len(want)
        for h, w in zip(have, want):
            assert h == pytest.approx(w, abs=1e-8)


def test_unjudged_query_drops_out(spark):
    run = spark.createDataFrame([(1, 10, 1), (2, 10, 1)], "query_id long, doc_id long, rnk int")
    qrels = spark.createDataFrame([(1, 10)], "query_id long, doc_id long")
    assert {r["query_id"] for r in ev.evaluate(run, qrels).collect()} == {1}
