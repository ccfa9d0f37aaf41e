import os
import random
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from rankfold.llm import jaccard_join, quality_classifier, queries, secrets, segment_sampling
from rankfold.llm.common import table

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF001):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF001}/{f}')")
    df = queries.QUERIES[name](spark, SF001)
    rel = con.sql(queries.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def test_stages_against_their_operators(spark):
    docs = table(spark, SF001, "documents")
    labels = table(spark, SF001, "labels")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mixing", "encoding"]
    good = corpus_pipeline.quality(spark, docs, SF001)
    want = {r.doc_id for r in quality_classifier.op6(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns
    single = corpus_pipeline.near_duplicates(spark, good, SF001)
    assert {r.doc_id for r in single.collect()} == {r.doc_id for r in jaccard_join.op4(good).where("doc_id = component_id").collect()}
    clean = corpus_pipeline.secret_scan(spark, single, SF001)
    assert all(not secrets.base_spans(r.text or "") for r in clean.collect()) and clean.schema == docs.schema
    mixed = corpus_pipeline.source_mixing(spark, clean, SF001)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    assert corpus_pipeline.run(spark, SF001).where("not decodes").isEmpty()


def test_near_duplicates_by_brute_force(spark):
    rng, rows = random.Random(5), []
    word = lambda: f"w{rng.randrange(5000)}"
    for i in range(0, 60, 2):
        w = [word() for _ in range(rng.choice([104, 304, 1004]))]
        rows += [(i, " ".join(w)), (i + 1, " ".join(w + [word() for _ in range(int(len(w) * rng.uniform(0.05, 0.4)))]))]
    rows += [(100, " ".join(f"a{i}" for i in range(1004))), (101, " ".join(f"a{i}" for i in range(1204)))]  # 1000 of 1200
    rows += [(102, " ".join(f"b{i}" for i in range(1004))), (103, " ".join(f"b{i}" for i in range(1255)))]  # 1000 of 1251
    grams = {i: {tuple(w[k: k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    kept = {i for i, s in grams.items() if not any(j < i and 10 * len(s & u) >= 8 * len(s | u) for j, u in grams.items())}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF001).collect()} == kept
    assert 101 not in kept and 103 in kept


def test_encoding_keeps_the_ids(spark):
    texts = {1: "two words", 2: "", 3: "Naïve  café ok", 4: "x" * 300, 5: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = segment_sampling.decode(corpus_pipeline.encoding(spark, docs, SF001)).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert all(r.text == (texts[r.doc_id] or "") and len(r.ids) == r.n_pieces for r in rows)
    assert all(zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc for r in rows)
