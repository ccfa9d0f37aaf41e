"""Impact index with block maxima, and exact BM25 top-k that skips postings.

A posting's impact is its BM25 weight without the query's term count, computed
once when the index is built. A term's postings fall into blocks of equal impact
level; each block's largest impact and size, and each term's, are kept apart.

Search, all queries in one plan:
  1. Threshold: the k-th best sum over a query's strongest terms alone (a share of
     ``SEED_SHARE`` of its postings, or one term's) is at most the k-th best score.
  2. Terms whose largest impacts together stay below the threshold can't bring a
     document into the answer: only documents of the other, essential, terms are
     candidates. Of an essential term, blocks are left out whose largest impact,
     with all other terms at their best, stays below the threshold.
  3. The candidates of which most was read are scored in full, by probing, which
     raises the threshold. Another stays if what was read of it, with everything
     unread at its best, reaches it; those that stay are probed as well.
Results equal ``lexical.bm25_search``; only fewer postings are joined
(``postings_read`` counts them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from rankfold.functions.scoring import bm25_weight, idf
from rankfold.operators.lexical import MAX_BROADCAST_QUERY_TERMS, LexicalIndex, query_terms
from rankfold.operators.rank import top_k
from rankfold.session import Owner, default_shards, fits, materialize, materialize_bucketed, owned

#: Impact levels of a term, each a block.
LEVELS = 32
#: Share of a query's postings that the threshold is taken from (at least one term's).
SEED_SHARE = 0.05
#: Candidates scored first, as a multiple of k.
AHEAD = 3
_EPS = 1e-5  # scores are rounded to six decimals


@dataclass(frozen=True)
class ImpactIndex:
    postings: DataFrame  # term, doc_id, level, impact: bucketed by doc_id
    blocks: DataFrame    # term, level, top, n
    terms: DataFrame     # term, top, df
    owner: Owner | None = None

    def drop(self) -> None:
        if self.owner:
            self.owner.drop()


def build_impacts(index: LexicalIndex, k1: float = 1.5, b: float = 0.75, variant: str = "lucene", levels: int = LEVELS) -> ImpactIndex:
    """Impacts of all postings of a lexical index, in its shards."""
    shards = index.shards or default_shards(index.postings.sparkSession, index.postings)
    weight = bm25_weight(F.lit(1.0), idf(index.n_docs(), F.col("df").cast("double")), F.col("tf").cast("double"), F.col("dl").cast("double"),
                         index.avgdl(), k1, b, variant)
    stats = F.broadcast(index.term_stats) if fits(index.term_stats) else index.term_stats
    with owned(index.postings.sparkSession, drop=False) as own:
        x = index.postings.join(stats, "term").select("term", "doc_id", weight.alias("impact"))
        tops = materialize(x.groupBy("term").agg(F.max("impact").alias("top"), F.count(F.lit(1)).alias("df")), "impact-terms")
        side = tops.select("term", "top")
        x = x.join(F.broadcast(side) if fits(side) else side, "term")
        level = F.least(F.floor(F.col("impact") / F.col("top") * levels), F.lit(levels - 1)).cast("int")
        x = x.select("term", "doc_id", F.coalesce(level, F.lit(0)).alias("level"), "impact")
        postings = materialize_bucketed(x, "impacts", "doc_id", shards)
        blocks = materialize(postings.groupBy("term", "level").agg(F.max("impact").alias("top"), F.count(F.lit(1)).alias("n")), "impact-blocks")
    return ImpactIndex(postings, blocks, tops, own)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, MAX_BROADCAST_QUERY_TERMS) else df


def _plan(queries: DataFrame, index: ImpactIndex, k: int, query_col: str, seed_share: float):
    """(query terms with their best, essential blocks with what skipping them may cost, thresholds)."""
    qt = query_terms(queries, query_col)
    qt = materialize(qt.join(index.terms, "term").withColumn("best", F.col("qtf") * F.col("top")), "impact-query-terms")
    strong = Window.partitionBy("query_id").orderBy(F.col("best").desc(), "term")
    there = F.sum("df").over(Window.partitionBy("query_id"))
    seeds = qt.withColumn("sofar", F.sum("df").over(strong)).withColumn("there", there)
    seeds = seeds.where((F.col("sofar") <= F.col("there") * seed_share) | (F.col("sofar") == F.col("df")))
    seeds = materialize(seeds.select("query_id", "term", "qtf", "df"), "impact-seeds")
    part = index.postings.select("term", "doc_id", "impact").join(_small(seeds.select("query_id", "term", "qtf")), "term")
    part = part.groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("impact")).alias("score"))
    kth = top_k(part, k).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    limits = materialize(kth.where(F.col("n") >= k).select("query_id", (F.col("low") - _EPS).alias("limit")), "impact-limits")
    weak = Window.partitionBy("query_id").orderBy("best", F.col("term").desc())
    x = qt.join(limits, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("-inf"))))
    x = x.withColumn("below", F.sum("best").over(weak)).withColumn("all", F.sum("best").over(Window.partitionBy("query_id")))
    x = x.withColumn("essential", F.col("below") >= F.col("limit"))
    slack = x.groupBy("query_id").agg(F.sum(F.when(~F.col("essential"), F.col("best")).otherwise(0.0)).alias("slack"), F.first("limit").alias("limit"))
    need = x.where("essential").select("query_id", "term", "qtf", "best", "all", "limit")
    blocks = need.join(index.blocks.select("term", "level", F.col("top").alias("block_top"), F.col("n").alias("block_n")), "term")
    reach = F.col("all") - F.col("best") + F.col("qtf") * F.col("block_top")
    blocks = materialize(blocks.withColumn("read", reach >= F.col("limit")), "impact-query-blocks")
    # of an essential term, the best that a left-out block could have added
    left = blocks.where("not read").groupBy("query_id", "term").agg(F.max(F.col("qtf") * F.col("block_top")).alias("m"))
    left = left.groupBy("query_id").agg(F.sum("m").alias("skipped"))
    slack = slack.join(left, "query_id", "left").select("query_id", "limit", (F.col("slack") + F.coalesce("skipped", F.lit(0.0))).alias("unread"))
    return qt, seeds, blocks.where("read"), materialize(slack, "impact-slack")


def _candidates(index: ImpactIndex, blocks: DataFrame, slack: DataFrame) -> DataFrame:
    """query_id, doc_id, seen, most (what was read, and that with all unread at its best) of those that may reach the threshold (written)."""
    read = index.postings.join(_small(blocks.select("query_id", "term", "level", "qtf")), ["term", "level"])
    sums = read.groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("impact")).alias("seen")).join(_small(slack), "query_id")
    sums = materialize(sums.select("query_id", "doc_id", "seen", (F.col("seen") + F.col("unread")).alias("most"), "limit").where("most >= limit"),
                       "impact-candidates")
    return sums


def _full(index: ImpactIndex, qt: DataFrame, cand: DataFrame) -> DataFrame:
    """query_id, doc_id, score, hits: the candidates' whole scores."""
    cand = cand.select("query_id", "doc_id")
    probe = cand.join(_small(qt.select("query_id", "term", "qtf")), "query_id")
    if fits(probe, MAX_BROADCAST_QUERY_TERMS):
        hits = index.postings.join(F.broadcast(probe), ["term", "doc_id"])
    else:
        # candidates meet their documents' postings in the documents' shards
        terms = _small(qt.select("query_id", "term", "qtf"))
        hits = index.postings.join(cand.hint("shuffle_hash"), "doc_id").join(terms, ["query_id", "term"])
    x = hits.groupBy("query_id", "doc_id").agg(F.sum(F.col("qtf") * F.col("impact")).alias("raw"), F.count(F.lit(1)).alias("hits"))
    return materialize(x, "impact-scores")


def impact_search(queries: DataFrame, index: ImpactIndex, k: int = 10, query_col: str = "query", digits: int = 6,
                  seed_share: float = SEED_SHARE, counts: dict | None = None) -> DataFrame:
    """Exact BM25 top-k: query_id, doc_id, score, rnk. ``counts`` receives how many postings were joined, and how many there are."""
    qt, seeds, blocks, slack = _plan(queries, index, k, query_col, seed_share)
    cand = _candidates(index, blocks, slack)
    ahead = top_k(cand, k * AHEAD, score="seen").select("query_id", "doc_id", F.lit(True).alias("ahead"))
    cand = materialize(cand.join(ahead, ["query_id", "doc_id"], "left"), "impact-ahead")
    first = _full(index, qt, cand.where("ahead"))
    kth = top_k(first, k, score="raw").groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("low"))
    kth = kth.where(F.col("n") >= k).select("query_id", (F.col("low") - _EPS).alias("raised"))
    rest = cand.where("ahead is null").join(_small(kth), "query_id", "left").where("raised is null or most >= raised")
    second = _full(index, qt, rest)
    scores = first.unionByName(second)
    if counts is not None:
        total = lambda df, c: df.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0]
        counts |= {"there": total(qt, "df"), "read": total(seeds, "df") + total(blocks, "block_n") + total(scores, "hits"), "candidates": scores.count()}
    return top_k(scores.select("query_id", "doc_id", F.round("raw", digits).alias("score")), k)
