"""The named query catalogue: each entry takes (spark, sf_dir) -> DataFrame.

Inputs are the whole given tables: text corpus = documents, text queries =
benchmark (judged by verbatim containment), vectors = embeddings (every vector
queries all others, judged by equal label, itself excluded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankfold.functions.scoring import safe_div, softmax_positive
from rankfold.functions.text import decimals, query_slug, tokenize
from rankfold.functions.stats import t_p_value
from rankfold.operators import encode, evaluate as ev, impact, judge, lexical, rank, scorer, training, vector_store, vectors
from rankfold.session import checkpoint_path, materialize, spread
from rankfold.sources import io, tables as T
from rankfold import streaming

K_SMALL = 10
K_LARGE = 100
N_TEST_QUERIES = 5
SEED = 42


# ---------------------------------------------------------------- shared parts

def _text(spark, sf):
    return T.corpus(spark, sf), T.text_queries(spark, sf)


def _bm25_run(spark, sf, k, variant="lucene", keep_text=False):
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs, keep_text=keep_text)
    return docs, qs, idx, lexical.bm25_search(qs, idx, k=k, variant=variant)


def _text_qrels(spark, sf, docs=None, qs=None, idx=None):
    if docs is None:
        docs, qs = _text(spark, sf)
    return judge.containment_qrels(qs, docs, idx)


def _query_hash_vectors(qs):
    # read twice (size check, broadcast): written once
    return materialize(encode.hash_vectors(lexical.query_terms(qs), qs, "query_id", "qtf"), "query-vectors")


def _hash_run(spark, sf, k, metric="l2", idx=None):
    """Hash vectors summed from the index's postings; without an index, in one pass over the texts."""
    docs, qs = _text(spark, sf)
    postings = (idx or lexical.build_index(docs, materialize=False)).postings
    return vectors.knn_search(_query_hash_vectors(qs), encode.hash_vectors(postings, docs), k=k, metric=metric)


def _vec_run(spark, sf, k, metric="l2", squared=True, strategy="auto", **kw):
    return vectors.knn_search(T.query_vectors(spark, sf), T.doc_vectors(spark, sf), k=k, metric=metric,
                              squared=squared, exclude_self=True, strategy=strategy, **kw)


def _vec_curve(spark, sf, run):
    flagged, n_rel = ev.flag_by_label(run, T.query_vectors(spark, sf), T.doc_vectors(spark, sf))
    return ev.metric_curve(flagged, n_rel, max_num=K_LARGE)


def _judged(spark, sf):
    docs, qs = _text(spark, sf)
    qrels = _text_qrels(spark, sf, docs, qs)
    return judge.judged_table(qs, qrels, docs)


# ---------------------------------------------------------------- index

def tokenize_terms(spark, sf):
    docs = T.corpus(spark, sf)
    toks = docs.select("doc_id", tokenize("text").alias("t"))
    return toks.select("doc_id", F.size("t").cast("long").alias("n_terms"),
                       F.size(F.array_distinct("t")).cast("long").alias("n_distinct"))


def corpus_stats(spark, sf):
    return lexical.corpus_statistics(T.corpus(spark, sf))


def doc_lengths(spark, sf):
    return T.corpus(spark, sf).select("doc_id", F.size(tokenize("text")).cast("int").alias("dl"))


def term_doc_freq(spark, sf):
    return lexical.build_index(T.corpus(spark, sf), materialize=False).term_stats


def postings_tf(spark, sf):
    return lexical.build_index(T.corpus(spark, sf), materialize=False).postings


# ---------------------------------------------------------------- BM25

def bm25_top10(spark, sf):
    return _bm25_run(spark, sf, K_SMALL)[3]


def bm25_okapi_top10(spark, sf):
    return _bm25_run(spark, sf, K_SMALL, variant="okapi")[3]


def bm25_top100(spark, sf):
    return _bm25_run(spark, sf, K_LARGE)[3]


def bm25_impacts_top10(spark, sf):
    """I1/I2 over precomputed impacts: blocks and terms below the threshold are skipped; equals bm25_top10."""
    docs, qs = _text(spark, sf)
    return impact.impact_search(qs, impact.build_impacts(lexical.build_index(docs)), k=K_SMALL)


# ---------------------------------------------------------------- judgements

def qrels_contains(spark, sf):
    return _text_qrels(spark, sf)


def judged_table(spark, sf):
    return _judged(spark, sf)


def query_docs_count(spark, sf):
    return _judged(spark, sf).select("query_id", "query_docs").distinct()


# ---------------------------------------------------------------- BM25 evaluation

def bm25_flagged(spark, sf):
    docs, qs, idx, run = _bm25_run(spark, sf, K_SMALL, keep_text=True)
    qrels = _text_qrels(spark, sf, docs, qs, idx)
    return ev.flag_relevant(run, qrels).join(docs, "doc_id").select(
        "query_id", "doc_id", "score", "rnk", "relevant", "text")


def bm25_missing_docs(spark, sf):
    docs, qs, idx, run = _bm25_run(spark, sf, K_SMALL, keep_text=True)
    return ev.missing_documents(run, _text_qrels(spark, sf, docs, qs, idx))


def bm25_run_summary(spark, sf):
    docs, qs, idx, run = _bm25_run(spark, sf, K_SMALL, keep_text=True)
    qrels = _text_qrels(spark, sf, docs, qs, idx)
    return ev.run_summary(ev.flag_relevant(run, qrels), ev.relevant_counts(qrels))


def bm25_curve(spark, sf):
    docs, qs, idx, run = _bm25_run(spark, sf, K_LARGE, keep_text=True)
    return ev.evaluate(run, _text_qrels(spark, sf, docs, qs, idx), max_num=K_LARGE)


def bm25_mean_curve(spark, sf):
    return ev.mean_curve(bm25_curve(spark, sf))


# ---------------------------------------------------------------- vectors

def l2_top10(spark, sf):
    return _vec_run(spark, sf, K_SMALL)


def l2_distance_top10(spark, sf):
    return _vec_run(spark, sf, K_SMALL, squared=False)


def cosine_top10(spark, sf):
    return _vec_run(spark, sf, K_SMALL, metric="cosine")


def l2_top10_grid(spark, sf):
    return _vec_run(spark, sf, K_SMALL, strategy="grid", min_blocks=2)


def l2_top10_cells(spark, sf):
    """I6 by cells with lower bounds: only cells that can hold an answer are searched."""
    return _vec_run(spark, sf, K_SMALL, strategy="cells")


def vector_store_top10(spark, sf):
    """A stored vector table, filled by two appends (the second sent twice), searched in another handle."""
    docs = T.doc_vectors(spark, sf)
    path = _scratch(spark, "vector-store")
    store = vector_store.create(docs, path)
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    store.append(docs.where(half == 0), 0)
    store.append(docs.where(half == 1), 1)
    store.append(docs.where(half == 1), 1)
    again = vector_store.VectorStore(spark, path)
    return again.search(T.query_vectors(spark, sf), K_SMALL, exclude_self=True)


def qrels_single_words(spark, sf):
    """C1 for passages without a key: the first word of every benchmark text, found verbatim in the documents."""
    docs, qs = _text(spark, sf)
    words = qs.select("query_id", F.regexp_extract("query", r"^[^\x20\x09-\x0D]+", 0).alias("query"))
    return judge.containment_qrels(words, docs)


def l2_curve(spark, sf):
    return _vec_curve(spark, sf, _vec_run(spark, sf, K_LARGE))


def l2_mean_curve(spark, sf):
    return ev.mean_curve(l2_curve(spark, sf))


def l2_run_summary(spark, sf):
    run = _vec_run(spark, sf, K_SMALL)
    flagged, n_rel = ev.flag_by_label(run, T.query_vectors(spark, sf), T.doc_vectors(spark, sf))
    return ev.run_summary(flagged, n_rel)


# ---------------------------------------------------------------- text vectors (I3, I4) and hybrid

def hash_embed_docs(spark, sf):
    return encode.hash_cells(lexical.build_index(T.corpus(spark, sf), materialize=False).postings)


def hash_l2_top10(spark, sf):
    return _hash_run(spark, sf, K_SMALL)


def hash_l2_missing_docs(spark, sf):
    """C6 on the vector run: judged documents the hash-vector top-10 misses."""
    docs, qs = _text(spark, sf)
    return ev.missing_documents(_hash_run(spark, sf, K_SMALL), _text_qrels(spark, sf, docs, qs))


def _fused(spark, sf, keep_text=False):
    docs, qs, idx, lex = _bm25_run(spark, sf, K_LARGE, keep_text=keep_text)
    vec = _hash_run(spark, sf, K_LARGE, idx=idx)
    return docs, qs, idx, lex, vec


def rrf_two_lists(spark, sf):
    _, _, _, lex, vec = _fused(spark, sf)
    return rank.rrf_two(lex, vec)


def rrf_nlists(spark, sf):
    _, _, _, lex, vec = _fused(spark, sf)
    return rank.rrf_many({"bm25": lex, "hash_l2": vec})


def rrf_three_lists(spark, sf):
    """J3 over three runs of one index: BM25, hash vectors, BM25 reranked by overlap."""
    docs, qs, idx, lex, vec = _fused(spark, sf)
    lex = materialize(lex, "run")
    third = rank.rerank(lexical.overlap_scores(lex, qs, idx)).select("query_id", "doc_id", F.col("new_rnk").alias("rnk"))
    return rank.rrf_many({"bm25": lex, "hash_l2": vec, "bm25_overlap": third})


def rrf_mean_curve(spark, sf):
    docs, qs, idx, lex, vec = _fused(spark, sf, keep_text=True)
    fused = rank.rrf_two(lex, vec)
    qrels = _text_qrels(spark, sf, docs, qs, idx)
    return ev.mean_curve(ev.evaluate(fused, qrels, max_num=K_LARGE))


# ---------------------------------------------------------------- rerank

def _overlap_reranked(spark, sf, base="bm25", keep_text=False):
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs, keep_text=keep_text)
    run = lexical.bm25_search(qs, idx, k=K_LARGE) if base == "bm25" else _hash_run(spark, sf, K_LARGE, idx=idx)
    # a run is small (queries x k) and is read twice by the scorer: write it once
    run = materialize(run.select("query_id", "doc_id", "score", "rnk"), "run")
    scored = lexical.overlap_scores(run, qs, idx)
    return docs, qs, idx, rank.rerank(scored)


def rerank_overlap(spark, sf):
    return _overlap_reranked(spark, sf)[3]


def rerank_overlap_mean_curve(spark, sf):
    docs, qs, idx, out = _overlap_reranked(spark, sf, keep_text=True)
    qrels = _text_qrels(spark, sf, docs, qs, idx)
    return ev.mean_curve(ev.evaluate(out, qrels, max_num=K_LARGE, rank_col="new_rnk"))


def hash_l2_rerank_overlap(spark, sf):
    return _overlap_reranked(spark, sf, base="hash_l2")[3]


def hash_l2_rerank_overlap_mean_curve(spark, sf):
    docs, qs, idx, out = _overlap_reranked(spark, sf, base="hash_l2", keep_text=True)
    qrels = _text_qrels(spark, sf, docs, qs, idx)
    return ev.mean_curve(ev.evaluate(out, qrels, max_num=K_LARGE, rank_col="new_rnk"))


def softmax_pair_probability(spark, sf):
    out = rerank_overlap(spark, sf)
    logits = F.array(-F.col("rerank"), F.col("rerank"))
    return out.select("query_id", "doc_id", F.round(softmax_positive(logits), 9).alias("p_relevant"))


def method_comparison_at5(spark, sf):
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs, keep_text=True)
    qrels = judge.containment_qrels(qs, docs, idx)
    lex = lexical.bm25_search(qs, idx, k=K_LARGE)
    vec = materialize(_hash_run(spark, sf, K_LARGE, idx=idx), "run")
    lex = materialize(lex, "run")
    fused = rank.rrf_two(lex, vec)
    rr = rank.rerank(lexical.overlap_scores(lex, qs, idx))
    vr = rank.rerank(lexical.overlap_scores(vec, qs, idx))
    curves = {
        "bm25": ev.mean_curve(ev.evaluate(lex, qrels)),
        "hash_l2": ev.mean_curve(ev.evaluate(vec, qrels)),
        "bm25_overlap": ev.mean_curve(ev.evaluate(rr, qrels, rank_col="new_rnk")),
        "hash_l2_overlap": ev.mean_curve(ev.evaluate(vr, qrels, rank_col="new_rnk")),
        "rrf": ev.mean_curve(ev.evaluate(fused, qrels)),
    }
    return ev.method_table(curves, at=5)


def score_regression(spark, sf):
    """K4: per query, regression of the overlap score on the BM25 score."""
    out = rerank_overlap(spark, sf)
    g = out.groupBy("query_id").agg(
        F.regr_count("rerank", "score").cast("long").alias("n"),
        F.regr_slope("rerank", "score").alias("slope"),
        F.regr_intercept("rerank", "score").alias("intercept"),
        F.corr("rerank", "score").alias("r"))
    t = F.col("r") * F.sqrt(safe_div(F.col("n") - 2, F.lit(1.0) - F.col("r") * F.col("r")))
    return g.select("query_id", "n", F.round("slope", 6).alias("slope"),
                    F.round("intercept", 6).alias("intercept"), F.round("r", 6).alias("r"),
                    F.round(F.when((F.col("n") > 2) & (F.abs(F.col("r")) < 1), t), 6).alias("t"))


# ---------------------------------------------------------------- training data

def split_by_query(spark, sf):
    train, test = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    return (train.select("query_id", "doc_id", F.lit("train").alias("part"))
            .unionByName(test.select("query_id", "doc_id", F.lit("test").alias("part"))))


def split_profile(spark, sf):
    train, test = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    return training.split_profile({"train": train, "test": test})


def negative_pairs(spark, sf):
    train, _ = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    return training.negative_pairs(train, SEED).select("query_id", "doc_id", "label")


def group_split(spark, sf):
    train, _ = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    # the pair table feeds both the sampled ids and the split: write it once
    pairs = materialize(training.training_pairs(train, SEED), "pairs")
    tr, va = training.group_split(pairs, 0.25, SEED)
    return (tr.select("query_id", "doc_id", "label", F.lit("train").alias("part"))
            .unionByName(va.select("query_id", "doc_id", "label", F.lit("validation").alias("part"))))


def _exact_split(spark, sf):
    train, _ = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    pairs = materialize(training.training_pairs(train, SEED).select("query_id", "doc_id", "label"), "pairs")
    return training.group_split(pairs, 0.25, SEED, exact=True)


def group_split_exact(spark, sf):
    """L4 with a sample of exactly floor(rows * 0.25) pairs."""
    tr, va = _exact_split(spark, sf)
    return (tr.select("query_id", "doc_id", "label", F.lit("train").alias("part"))
            .unionByName(va.select("query_id", "doc_id", "label", F.lit("validation").alias("part"))))


def label_profile(spark, sf):
    tr, va = _exact_split(spark, sf)
    return training.label_profile({"train": tr, "validation": va})


def labelled_pairs(spark, sf):
    train, _ = training.split_by_query(_judged(spark, sf), N_TEST_QUERIES)
    return training.labelled_pairs(training.training_pairs(train, SEED))


def frequency_tables(spark, sf):
    j = _judged(spark, sf)
    by_q = j.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("query").alias("kind"), F.col("query_id").alias("key"), "n")
    by_d = j.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("doc").alias("kind"), F.col("doc_id").alias("key"), "n")
    return by_q.unionByName(by_d)


def query_snapshot20(spark, sf):
    j = _judged(spark, sf).select("query_id", "query", "query_docs").distinct()
    return j.orderBy("query_docs", "query_id").limit(20)


def query_slug_names(spark, sf):
    qs = T.text_queries(spark, sf)
    return qs.select("query_id", query_slug("query").alias("slug"))


def bm25_padded_top10(spark, sf):
    """Q3 pad=True: k rows per query, zero-score documents by doc_id after the matches."""
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs)
    return lexical.bm25_search_padded(qs, idx, docs, k=K_SMALL)


def score_regression_pvalue(spark, sf):
    """K4 with the two-sided Student-t p-value (df = n - 2)."""
    g = score_regression(spark, sf)
    return g.withColumn("p", F.round(t_p_value(F.col("t"), F.col("n") - 2), 6))


# ---------------------------------------------------------------- sinks

def _scratch(spark, name):
    import uuid

    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def answers_tsv_roundtrip(spark, sf):
    flagged = bm25_flagged(spark, sf)
    path = _scratch(spark, "answers-tsv")
    io.write_tsv(flagged, path)
    schema = "query_id LONG, doc_id LONG, score DOUBLE, rnk INT, relevant STRING, text STRING"
    return io.read_tsv(spark, path, schema)


def fused_tsv_roundtrip(spark, sf):
    """The fused list as TSV, its scores as text of five decimals, read back."""
    _, _, _, lex, vec = _fused(spark, sf)
    out = rank.rrf_two(lex, vec).select("query_id", "doc_id", "rank1", "rank2", decimals("rerank", 5).alias("rerank"), "rnk")
    path = _scratch(spark, "fused-tsv")
    io.write_tsv(out, path)
    return io.read_tsv(spark, path, "query_id LONG, doc_id LONG, rank1 DOUBLE, rank2 DOUBLE, rerank STRING, rnk INT")


def answers_jsonl_roundtrip(spark, sf):
    flagged = bm25_flagged(spark, sf)
    path = _scratch(spark, "answers-jsonl")
    io.write_jsonl(flagged, path)
    schema = "query_id LONG, doc_id LONG, score DOUBLE, rnk INT, relevant STRING, text STRING"
    return io.read_jsonl(spark, path, schema)


def per_query_export(spark, sf):
    docs, qs, idx, run = _bm25_run(spark, sf, K_SMALL)
    path = _scratch(spark, "per-query")
    io.write_per_query(io.with_query_slug(run.join(qs, "query_id")).drop("query"), path, fmt="parquet")
    back = (spark.read.option("basePath", path).schema(
        "doc_id LONG, score DOUBLE, rnk INT, query_slug STRING, query_id STRING").parquet(path))
    return back.select(F.col("query_id").cast("long").alias("query_id"), "query_slug", "doc_id", "score", "rnk")


# ---------------------------------------------------------------- learned scorer

def _fitted_scorer(spark, sf):
    """(queries, index, judgements, model, featured validation pairs)."""
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs, keep_text=True)
    qrels = judge.containment_qrels(qs, docs, idx)
    # Written tables cut the lineage: the pair table feeds several branches and
    # MLlib runs several actions over its input.
    judged = materialize(judge.judged_table(qs, qrels, docs), "judged")
    train, _ = training.split_by_query(judged, N_TEST_QUERIES)
    pairs = materialize(training.training_pairs(train, SEED).select("query_id", "doc_id", "label"), "pairs")
    tr, va = training.group_split(pairs, 0.25, SEED)
    tr_f = materialize(scorer.pair_features(tr, qs, idx), "scorer-train")
    va_f = materialize(scorer.pair_features(va, qs, idx), "scorer-valid")
    return qs, idx, qrels, scorer.fit_scorer(tr_f), va_f


def _scored_pairs(spark, sf):
    *_, model, va_f = _fitted_scorer(spark, sf)
    return scorer.score_with(model, va_f)


def pair_features(spark, sf):
    """The scorer's features of all training pairs."""
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs, keep_text=True)
    judged = materialize(judge.judged_table(qs, judge.containment_qrels(qs, docs, idx), docs), "judged")
    train, _ = training.split_by_query(judged, N_TEST_QUERIES)
    pairs = materialize(training.training_pairs(train, SEED).select("query_id", "doc_id", "label"), "pairs")
    f = scorer.pair_features(pairs, qs, idx)
    return f.select("query_id", "doc_id", "label", F.round("bm25", 6).alias("bm25"), "overlap",
                    F.round("log_dl", 9).alias("log_dl"), "nq", "l2")


def _learned_curve(run, qs, idx, qrels, model):
    run = materialize(run, "run")
    return ev.mean_curve(ev.evaluate(rank.rerank(scorer.score_with(model, scorer.pair_features(run, qs, idx))), qrels,
                                     max_num=K_LARGE, rank_col="new_rnk"))


def learned_rerank_mean_curve(spark, sf):
    """The BM25 run reranked by the fitted scorer, averaged curve."""
    qs, idx, qrels, model, _ = _fitted_scorer(spark, sf)
    return _learned_curve(lexical.bm25_search(qs, idx, k=K_LARGE), qs, idx, qrels, model)


def learned_rerank_hash_mean_curve(spark, sf):
    """The hash-vector run reranked by the fitted scorer, averaged curve."""
    qs, idx, qrels, model, _ = _fitted_scorer(spark, sf)
    return _learned_curve(_hash_run(spark, sf, K_LARGE, idx=idx), qs, idx, qrels, model)


def method_comparison_learned_at5(spark, sf):
    """K5 with learned rows: the lexical, vector and fused runs at rank 5, each alone and reranked by the fitted scorer."""
    qs, idx, qrels, model, _ = _fitted_scorer(spark, sf)
    lex = materialize(lexical.bm25_search(qs, idx, k=K_LARGE), "run")
    vec = materialize(_hash_run(spark, sf, K_LARGE, idx=idx), "run")
    fused = rank.rrf_two(lex, vec).where(F.col("rnk") <= K_LARGE).select("query_id", "doc_id", F.col("rerank").alias("score"), "rnk")
    curves = {}
    for name, run in (("bm25", lex), ("hash_l2", vec), ("rrf", fused)):
        curves[name] = ev.mean_curve(ev.evaluate(run, qrels))
        curves[f"{name}_learned"] = _learned_curve(run, qs, idx, qrels, model)
    return ev.method_table(curves, at=5)


# ---------------------------------------------------------------- model hooks

def _counting_encoder():
    """A stand-in for a user's encoder: characters, spaces and e's of a text."""
    import numpy as np

    return lambda texts: np.array([[len(t or ""), (t or "").count(" "), (t or "").count("e")] for t in texts], np.float32)


def _length_scorer():
    """A stand-in for a user's pair model: two logits from the lengths of query and text."""
    import numpy as np

    return lambda q, t: np.array([[len(a or "") / 100, len(b or "") / 1000] for a, b in zip(q, t)])


def model_hook_vectors(spark, sf):
    v = encode.encode_with(spread(T.corpus(spark, sf)), "text", _counting_encoder, 3)
    return v.select("doc_id", *[F.col("embedding")[i].cast("long").alias(n) for i, n in enumerate(("chars", "spaces", "letters_e"))])


def model_hook_scores(spark, sf):
    docs, qs, _, run = _bm25_run(spark, sf, K_SMALL)
    pairs = run.select("query_id", "doc_id").join(qs, "query_id").join(docs, "doc_id")
    scored = encode.score_pairs_with(pairs, _length_scorer)
    return scored.select("query_id", "doc_id", F.round("rerank", 9).alias("p_relevant"))


def pair_scorer_predictions(spark, sf):
    return _scored_pairs(spark, sf).select("query_id", "doc_id", "label", "rerank", "predicted")


def pair_scorer_quality(spark, sf):
    return scorer.quality(_scored_pairs(spark, sf))


# ---------------------------------------------------------------- streaming (M1, M2)

def _ingested(spark, sf):
    """A snapshot of the corpus streamed in as 4 files, one per trigger."""
    src = streaming.ingest.stage_files(T.corpus(spark, sf), "ingest-src", 4)
    root = _scratch(spark, "ingest-index")
    q = streaming.start_ingest(spark, src, root, max_files_per_trigger=1)
    q.awaitTermination()
    return streaming.snapshot(spark, root)


def incremental_index_state(spark, sf):
    """M1: documents streamed in; final df equals the batch build."""
    return _ingested(spark, sf).index().term_stats


def incremental_corpus_stats(spark, sf):
    return _ingested(spark, sf).index().corpus_stats


def incremental_vectors(spark, sf):
    """The non-zero cells of the vectors stored by the ingest; equal hash_embed_docs."""
    v = _ingested(spark, sf).vectors().vectors()
    return (v.select("doc_id", F.posexplode("embedding").alias("dim", "value")).where("value <> 0")
            .select("doc_id", F.col("dim").cast("int").alias("dim"), F.round("value", 9).alias("value")))


def incremental_distinct_counts(spark, sf):
    """D3: distinct terms and documents, exact, and whether the merged sketches lie within five standard errors."""
    snap = _ingested(spark, sf)
    exact = snap.index().term_stats.agg(F.count(F.lit(1)).alias("n")).select(F.lit("term").alias("counted"), "n")
    exact = exact.unionByName(snap.documents().agg(F.count(F.lit(1)).alias("n")).select(F.lit("doc_id").alias("counted"), "n"))
    bound = 5 * 1.04 / 2 ** (streaming.ingest.SKETCH_BITS / 2)
    near = F.abs(F.col("estimate") - F.col("n")) <= F.col("n") * bound
    return exact.join(snap.distinct_counts(), "counted").select("counted", F.col("n").alias("exact"), near.alias("estimate_within_bound"))


def stream_answers(spark, sf):
    """M2: benchmark queries streamed as 4 files against the corpus index; equals bm25_top10."""
    docs, qs = _text(spark, sf)
    idx = lexical.build_index(docs)
    src = streaming.ingest.stage_files(qs, "query-src", 4)
    out = _scratch(spark, "stream-answers")
    q = streaming.start_answering(spark, src, idx, out, k=K_SMALL)
    q.awaitTermination()
    return streaming.read_answers(spark, out)


def stream_answers_fused(spark, sf):
    """Streamed queries against a pinned snapshot of a streamed corpus, BM25 and stored vectors fused."""
    retrieve = streaming.snapshot_retriever(_ingested(spark, sf), K_LARGE)
    src = streaming.ingest.stage_files(T.text_queries(spark, sf), "query-src", 4)
    out = _scratch(spark, "stream-answers")
    q = streaming.start_answering(spark, src, retrieve, out)
    q.awaitTermination()
    return streaming.read_answers(spark, out)


QUERIES = {
    "tokenize_terms": tokenize_terms,
    "corpus_stats": corpus_stats,
    "doc_lengths": doc_lengths,
    "term_doc_freq": term_doc_freq,
    "postings_tf": postings_tf,
    "bm25_top10": bm25_top10,
    "bm25_okapi_top10": bm25_okapi_top10,
    "bm25_top100": bm25_top100,
    "bm25_impacts_top10": bm25_impacts_top10,
    "qrels_contains": qrels_contains,
    "judged_table": judged_table,
    "query_docs_count": query_docs_count,
    "bm25_flagged": bm25_flagged,
    "bm25_missing_docs": bm25_missing_docs,
    "bm25_run_summary": bm25_run_summary,
    "bm25_curve": bm25_curve,
    "bm25_mean_curve": bm25_mean_curve,
    "l2_top10": l2_top10,
    "l2_distance_top10": l2_distance_top10,
    "cosine_top10": cosine_top10,
    "l2_top10_grid": l2_top10_grid,
    "l2_top10_cells": l2_top10_cells,
    "vector_store_top10": vector_store_top10,
    "qrels_single_words": qrels_single_words,
    "l2_curve": l2_curve,
    "l2_mean_curve": l2_mean_curve,
    "l2_run_summary": l2_run_summary,
    "hash_embed_docs": hash_embed_docs,
    "hash_l2_top10": hash_l2_top10,
    "hash_l2_missing_docs": hash_l2_missing_docs,
    "rrf_two_lists": rrf_two_lists,
    "rrf_nlists": rrf_nlists,
    "rrf_three_lists": rrf_three_lists,
    "rrf_mean_curve": rrf_mean_curve,
    "rerank_overlap": rerank_overlap,
    "rerank_overlap_mean_curve": rerank_overlap_mean_curve,
    "hash_l2_rerank_overlap": hash_l2_rerank_overlap,
    "hash_l2_rerank_overlap_mean_curve": hash_l2_rerank_overlap_mean_curve,
    "softmax_pair_probability": softmax_pair_probability,
    "method_comparison_at5": method_comparison_at5,
    "score_regression": score_regression,
    "split_by_query": split_by_query,
    "split_profile": split_profile,
    "negative_pairs": negative_pairs,
    "group_split": group_split,
    "group_split_exact": group_split_exact,
    "label_profile": label_profile,
    "labelled_pairs": labelled_pairs,
    "frequency_tables": frequency_tables,
    "query_snapshot20": query_snapshot20,
    "query_slug": query_slug_names,
    "bm25_padded_top10": bm25_padded_top10,
    "score_regression_pvalue": score_regression_pvalue,
    "answers_tsv_roundtrip": answers_tsv_roundtrip,
    "answers_jsonl_roundtrip": answers_jsonl_roundtrip,
    "fused_tsv_roundtrip": fused_tsv_roundtrip,
    "per_query_export": per_query_export,
    "pair_features": pair_features,
    "pair_scorer_predictions": pair_scorer_predictions,
    "pair_scorer_quality": pair_scorer_quality,
    "learned_rerank_mean_curve": learned_rerank_mean_curve,
    "learned_rerank_hash_mean_curve": learned_rerank_hash_mean_curve,
    "method_comparison_learned_at5": method_comparison_learned_at5,
    "model_hook_vectors": model_hook_vectors,
    "model_hook_scores": model_hook_scores,
    "incremental_index_state": incremental_index_state,
    "incremental_corpus_stats": incremental_corpus_stats,
    "incremental_vectors": incremental_vectors,
    "incremental_distinct_counts": incremental_distinct_counts,
    "stream_answers": stream_answers,
    "stream_answers_fused": stream_answers_fused,
}
