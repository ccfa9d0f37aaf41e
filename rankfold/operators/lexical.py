"""The lexical (BM25) index as three tables, and BM25 top-k search.

Index tables:
  postings     term STRING, doc_id LONG, dl INT, tf LONG
  term_stats   term STRING, df LONG
  doc_stats    doc_id LONG, dl INT, n_terms LONG          (documents with >= 1 term)
  corpus_stats n_docs LONG, total_len LONG, avgdl DOUBLE   (one row)
  texts        doc_id LONG, text STRING                    (optional, beside the postings)

N and avgdl reach the scoring expression as scalar subqueries (one value
each, computed once per query plan) - no cross join and no driver loop.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F

from rankfold.functions.scoring import bm25_weight, idf
from rankfold.functions.text import tokenize
from rankfold.operators.rank import top_k
from rankfold.schemas import require_columns
from rankfold.session import Owner, default_shards, fits, materialize as write_table, materialize_bucketed, owned, table_size

# Query-term tables at most this long (and within the byte bound of ``fits``) are
# broadcast into the postings scan.
MAX_BROADCAST_QUERY_TERMS = 2_000_000


@dataclass(frozen=True)
class LexicalIndex:
    postings: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    lazy_doc_stats: DataFrame
    texts: DataFrame | None = None
    #: Buckets of the written tables; 0 for an index that is a plan only.
    shards: int = 0
    #: Rows and bytes of text the build has read.
    profile: dict = field(default_factory=dict)
    owner: Owner | None = None

    @cached_property
    def doc_stats(self) -> DataFrame:
        """Written beside the postings on first use (grouped by the bucket key, no exchange), then probed."""
        if not self.shards:
            return self.lazy_doc_stats
        with owned(self.postings.sparkSession, drop=False) as own:
            out = materialize_bucketed(self.lazy_doc_stats, "doc_stats", "doc_id", self.shards)
        if self.owner:
            self.owner.tables += own.tables
            self.owner.paths += own.paths
        return out

    def n_docs(self):
        return self.corpus_stats.select(F.col("n_docs").cast("double")).scalar()

    def avgdl(self):
        return self.corpus_stats.select("avgdl").scalar()

    def drop(self) -> None:
        """Remove the tables the build has written."""
        if self.owner:
            self.owner.drop()

    def __enter__(self) -> LexicalIndex:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def index_documents(corpus: DataFrame, dedupe: str | None = None) -> DataFrame:
    """The documents the index holds (doc_id, text).

    ``dedupe=None`` keeps the input as is (doc_id is a key);
    ``'doc_id'`` keeps one row per doc_id (a judged table repeats documents);
    ``'text'`` keeps the smallest doc_id of each distinct text.
    """
    require_columns(corpus, "doc_id", "text", what="corpus")
    docs = corpus.select("doc_id", "text")
    if dedupe is None:
        return docs
    if dedupe == "doc_id":
        return docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    if dedupe == "text":
        return docs.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    raise ValueError(f"unknown dedupe rule {dedupe!r}")


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """What an observation has counted while its plan ran."""
    try:
        got = seen.get
    except Py4JJavaError:  # the plan turned out to be empty and was dropped, with the operator that counts
        got = {}
    return {n: got.get(n) or 0 for n in names}


def build_index(corpus: DataFrame, dedupe: str | None = None, materialize: bool = True,
                shards: int | None = None, keep_text: bool = False) -> LexicalIndex:
    """I1 + D8: a document-sharded inverted index.

    Documents are hash-partitioned by doc_id into ``shards`` (one shuffle of the
    text, which is smaller than the postings it yields), as many as the bytes of
    the texts ask for (one pass over them counts those first); tokenising,
    exploding and counting (doc_id, term) then happen inside each shard with no
    further exchange, and document length rides along each posting. With
    ``materialize`` the postings and per-document stats are written as tables
    bucketed by doc_id, so searches aggregate per (query, document) inside each
    shard and only per-shard top-k rows are shuffled. A frequent term's
    postings are spread over all shards, so hot terms cause no skew.

    ``keep_text`` writes the texts into the same shards, so that a candidate's
    text is met there without an exchange. What is written belongs to the index:
    ``drop`` (or ``with build_index(...) as idx``) removes it. ``profile`` tells
    the rows and bytes the build has read, observed while it wrote.
    """
    spark = corpus.sparkSession
    docs = index_documents(corpus, dedupe)
    shards = shards or default_shards(spark, docs, table_size(corpus.select("doc_id", "text"))[1])
    seen = Observation("index documents")
    with owned(spark, drop=False) as owner:
        source = docs
        if materialize:
            source = docs.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"),
                                  F.count("text").alias("texts"))
        sharded, texts = source.repartition(shards, "doc_id"), None
        if keep_text and materialize:
            sharded = texts = materialize_bucketed(sharded, "texts", "doc_id", shards)
        toks = sharded.select("doc_id", tokenize("text").alias("tokens"))
        # explode_outer + null filter: an inner explode makes Catalyst infer
        # size(tokens) > 0 below the projection, which tokenises every row twice.
        postings = (toks.select("doc_id", F.size("tokens").cast("int").alias("dl"),
                                F.explode_outer("tokens").alias("term"))
                    .where(F.col("term").isNotNull())
                    .groupBy("doc_id", "term").agg(F.max("dl").alias("dl"), F.count(F.lit(1)).alias("tf"))
                    .select("term", "doc_id", "dl", "tf"))
        profile = {}
        if materialize:
            postings = materialize_bucketed(postings, "postings", "doc_id", shards)
            profile = observed(seen, "rows", "texts", "bytes")
        doc_stats = postings.groupBy("doc_id").agg(F.max("dl").alias("dl"), F.count(F.lit(1)).alias("n_terms"))
        term_stats = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        n_docs = docs.select(F.count(F.lit(1)).alias("n_docs"))
        if materialize:  # counted while the documents were read
            n_docs = spark.range(1).select(F.lit(profile["rows"]).cast("long").alias("n_docs"))
        total = postings.select(F.coalesce(F.sum("tf"), F.lit(0)).cast("long").alias("total_len"))
        corpus_stats = (n_docs.select(F.col("n_docs"), total.select("total_len").scalar().alias("total_len"))
                        .withColumn("avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs").cast("double"))))
        if materialize:
            # Every search needs both; written once, scoring is the only scan of the postings.
            term_stats = write_table(term_stats, "term-stats")
            corpus_stats = write_table(corpus_stats, "corpus-stats")
    return LexicalIndex(postings, term_stats, corpus_stats, doc_stats, texts, shards if materialize else 0, profile, owner)


def corpus_statistics(corpus: DataFrame, dedupe: str | None = None) -> DataFrame:
    """D8 alone: n_docs, total_len, avgdl (null for no documents) in one narrow pass, without an index."""
    one = index_documents(corpus, dedupe).select(F.size(tokenize("text")).alias("dl")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("dl"), F.lit(0)).cast("long").alias("total_len"))
    return one.withColumn("avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs").cast("double")))


def query_terms(queries: DataFrame, query_col: str = "query") -> DataFrame:
    """query_id, term, qtf: repeated query words count repeatedly."""
    require_columns(queries, "query_id", query_col, what="queries")
    return (queries.select("query_id", F.explode(tokenize(query_col)).alias("term"))
            .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf")))


def bm25_scores(queries: DataFrame, index: LexicalIndex, k1: float = 1.5, b: float = 0.75,
                variant: str = "lucene", query_col: str = "query", digits: int = 6,
                broadcast_limit: int = MAX_BROADCAST_QUERY_TERMS) -> DataFrame:
    """All (query_id, doc_id, score) with at least one shared term; score rounded."""
    qt = query_terms(queries, query_col)
    small = fits(qt, broadcast_limit)
    # df only for the query vocabulary (over lazy statistics the semi join is
    # pushed below the df aggregation).
    vocab = qt.select("term").distinct()
    tdf = index.term_stats.join(F.broadcast(vocab) if small else vocab, "term", "left_semi")
    weights = (qt.join(F.broadcast(tdf) if small else tdf, "term")
               .withColumn("idf", idf(index.n_docs(), F.col("df").cast("double"))))
    if small:
        cand = index.postings.join(F.broadcast(weights), "term")
    else:
        # Too many (query, term) rows to broadcast: shuffle-join on term, but
        # first cut the postings to the query vocabulary (map-side, when the
        # vocabulary itself fits), so only those postings are shuffled.
        postings = index.postings
        if fits(vocab, broadcast_limit):
            postings = postings.join(F.broadcast(vocab), "term", "left_semi")
        cand = postings.join(weights, "term")
    w = bm25_weight(F.col("qtf").cast("double"), F.col("idf"), F.col("tf").cast("double"),
                    F.col("dl").cast("double"), index.avgdl(), k1, b, variant)
    return (cand.groupBy("query_id", "doc_id").agg(F.sum(w).alias("raw"))
            .select("query_id", "doc_id", F.round("raw", digits).alias("score")))


def overlap_scores(pairs: DataFrame, queries: DataFrame, index: LexicalIndex,
                   query_col: str = "query", out: str = "rerank", digits: int = 9,
                   broadcast_limit: int = MAX_BROADCAST_QUERY_TERMS) -> DataFrame:
    """J1 ``token_overlap`` for (query_id, doc_id) pairs, answered from the index.

    Jaccard of distinct terms = m / (|Q| + n_terms(d) - m), m = distinct query
    terms present in d (matching postings). Document texts are never
    re-tokenised: the (pair, query term) rows are probed against the postings
    when their size allows a broadcast. Otherwise the pairs go to the postings'
    doc_id shards and meet each answered document's term list there; the
    postings themselves are not shuffled.
    """
    qv = queries.select("query_id", F.array_distinct(tokenize(query_col)).alias("qv"))
    probe = (pairs.select("query_id", "doc_id").join(qv, "query_id")
             .select("query_id", "doc_id", F.explode("qv").alias("term")))
    if fits(probe, broadcast_limit):
        hits = (index.postings.select("term", "doc_id").join(F.broadcast(probe), ["term", "doc_id"])
                .groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("m")))
    else:
        keys = pairs.select("query_id", "doc_id").distinct().join(qv, "query_id")
        terms = (index.postings.select("doc_id", "term")
                 .join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
                 .groupBy("doc_id").agg(F.collect_list("term").alias("terms")))
        hits = terms.join(keys, "doc_id").select(
            "query_id", "doc_id", F.size(F.array_intersect("qv", "terms")).cast("long").alias("m"))
    ds = index.doc_stats.select("doc_id", "n_terms")
    full = (pairs.join(qv.select("query_id", F.size("qv").cast("long").alias("nq")), "query_id", "left")
            .join(ds, "doc_id", "left").join(hits, ["query_id", "doc_id"], "left")
            .fillna(0, subset=["nq", "n_terms", "m"]))
    union = F.col("nq") + F.col("n_terms") - F.col("m")
    score = F.when(union > 0, F.col("m").cast("double") / union.cast("double")).otherwise(F.lit(0.0))
    return full.withColumn(out, F.round(score, digits)).drop("nq", "n_terms", "m")


def bm25_search(queries: DataFrame, index: LexicalIndex, k: int = 10, **kw) -> DataFrame:
    """Top-k per query: query_id, doc_id, score, rnk (1-based, ties by doc_id)."""
    return top_k(bm25_scores(queries, index, **kw), k)


def bm25_search_padded(queries: DataFrame, index: LexicalIndex, corpus: DataFrame, k: int = 10,
                       **kw) -> DataFrame:
    """Q3 ``pad=True``: always k rows per query (while the corpus allows);
    documents sharing no term follow with score 0.0 in doc_id order.

    Only the k smallest doc_ids can ever be needed as padding: they reach each
    query row as one k-element array (a scalar subquery) and are exploded.
    """
    scored = bm25_scores(queries, index, **kw)
    pad_ids = corpus.select("doc_id").distinct().orderBy("doc_id").limit(k).agg(
        F.sort_array(F.collect_list("doc_id")).alias("ids")).scalar()
    # the filter goes down to the postings of those k documents, so no other score is computed or moved for the pads
    matched = scored.where(F.array_contains(pad_ids, F.col("doc_id"))).select("query_id", "doc_id")
    pads = (queries.select("query_id").distinct()
            .select("query_id", F.explode(pad_ids).alias("doc_id"), F.lit(0.0).alias("score"))
            .join(matched, ["query_id", "doc_id"], "left_anti"))
    return top_k(scored.unionByName(pads), k)


def save_index(index: LexicalIndex, path: str, range_parts: int | None = None,
               table_prefix: str | None = None, shards: int | None = None) -> None:
    """Persist the index tables under ``path``.

    With ``table_prefix`` the postings and doc stats become catalog tables
    bucketed by doc_id (``shards`` buckets), so a later session that shares
    the catalog searches shard-locally, as right after the build. Without it,
    postings are plain parquet range-partitioned and sorted by term: each file
    covers a disjoint term range and parquet min/max statistics let term
    lookups skip files and row groups.
    """
    import os

    spark = index.postings.sparkSession
    if table_prefix:
        n = shards or default_shards(spark)
        for name, df in (("postings", index.postings), ("doc_stats", index.doc_stats)):
            (df.repartition(n, "doc_id").write.bucketBy(n, "doc_id").mode("overwrite")
             .option("path", os.path.join(path, name)).saveAsTable(f"{table_prefix}_{name}"))
    else:
        n = range_parts or max(1, spark.sparkContext.defaultParallelism)
        (index.postings.repartitionByRange(n, "term").sortWithinPartitions("term", "doc_id")
         .write.mode("overwrite").parquet(os.path.join(path, "postings")))
        index.doc_stats.write.mode("overwrite").parquet(os.path.join(path, "doc_stats"))
    index.term_stats.write.mode("overwrite").parquet(os.path.join(path, "term_stats"))
    index.corpus_stats.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "corpus_stats"))


def load_index(spark, path: str, table_prefix: str | None = None) -> LexicalIndex:
    """Read an index written by :func:`save_index` (or by the streaming ingest)."""
    import os

    r = spark.read
    if table_prefix:
        postings, doc_stats = spark.table(f"{table_prefix}_postings"), spark.table(f"{table_prefix}_doc_stats")
    else:
        postings, doc_stats = r.parquet(os.path.join(path, "postings")), r.parquet(os.path.join(path, "doc_stats"))
    return LexicalIndex(postings, r.parquet(os.path.join(path, "term_stats")),
                        r.parquet(os.path.join(path, "corpus_stats")), doc_stats)
