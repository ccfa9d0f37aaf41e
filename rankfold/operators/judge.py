"""Relevance judgements derived from the data.

Text: a document is relevant to a passage query when it contains the passage
verbatim. Exact, without a cross join: every term of the passage that does
not touch its ends is a whole term of any document containing it, so the
passage's rarest such term (smallest document frequency) is an equi-join key
into the postings; a passage with such a term that no document has matches
nothing and drops out at once. Candidates are verified with ``contains`` on the
full text; where the index keeps its texts, candidate and text meet in the
document's shard and no text is moved.

A passage without any such term (fewer than three word runs, or only stop words
inside) has no key. All such passages are one automaton, and every document's
text runs through it once: it reports each passage that ends at each character,
so nothing is cut into character n-grams and nothing is verified again. The
passages are shared with the tasks in blocks of bounded size, one pass a block.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankfold.functions.text import interior_terms
from rankfold.operators.lexical import LexicalIndex, build_index
from rankfold.session import fits, materialize as _materialize, table_size

MAX_BROADCAST_KEYS = 2_000_000
PATTERN_BYTES = 8 * 1024 * 1024  # passages of one automaton, about (its states are as many as their characters at most)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, MAX_BROADCAST_KEYS) else df


def _term_candidates(q: DataFrame, index: LexicalIndex, materialize: bool) -> DataFrame:
    """query_id, doc_id: documents with the rarest interior term of the passage."""
    qterms = q.select("query_id", F.explode("terms").alias("term"))
    small = fits(qterms, MAX_BROADCAST_KEYS)
    vocab = qterms.select("term").distinct()
    tdf = index.term_stats.join(F.broadcast(vocab) if small else vocab, "term", "left_semi")
    pick = Window.partitionBy("query_id").orderBy(F.col("df").asc(), F.col("term").asc())
    keys = (qterms.join(F.broadcast(tdf) if small else tdf, "term", "left")
            .withColumn("df", F.coalesce("df", F.lit(0)))
            .withColumn("_r", F.row_number().over(pick)).where((F.col("_r") == 1) & (F.col("df") > 0))
            .select("query_id", "term"))
    keys = _materialize(keys, "containment-keys") if materialize else keys
    return index.postings.select("term", "doc_id").join(_small(keys), "term").select("query_id", "doc_id")


def multi_contains(texts: DataFrame, patterns: DataFrame, pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """query_id, doc_id for every (doc_id, text) that contains the ``passage`` of a (query_id, passage) row.

    Aho-Corasick: each text is read once a block of passages, whatever their number. Null and empty passages and
    null texts match nothing. Repeated rows: a pair is given once per row of the texts.
    """
    import ahocorasick

    grouped = patterns.where(F.col("passage").isNotNull() & (F.length("passage") > 0)).groupBy("passage").agg(
        F.sort_array(F.collect_set("query_id")).alias("ids"))
    grouped = _materialize(grouped, "containment-patterns")
    blocks = max(1, -(-table_size(grouped)[1] // pattern_bytes))
    kinds = [df.select(c).schema[0].dataType.simpleString() for df, c in ((patterns, "query_id"), (texts, "doc_id"))]
    ddl = f"query_id {kinds[0]}, doc_id {kinds[1]}"
    target = to_arrow_schema(StructType.fromDDL(ddl))
    spark, found = texts.sparkSession, None
    for b in range(blocks):
        rows = [(r[0], list(r[1])) for r in grouped.where(F.pmod(F.xxhash64("passage"), F.lit(blocks)) == b).collect()]
        shared = spark.sparkContext.broadcast(rows)

        def run(batches, shared=shared):
            automaton = ahocorasick.Automaton()
            for passage, ids in shared.value:
                automaton.add_word(passage, ids)
            automaton.make_automaton()
            for batch in batches:
                queries, docs = [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if text and shared.value:
                        seen = {id(ids): ids for _, ids in automaton.iter(text)}
                        hits = [q for ids in seen.values() for q in ids]
                        queries += hits
                        docs += [doc] * len(hits)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((queries, docs), target)], schema=target)

        part = texts.select("doc_id", "text").mapInArrow(run, ddl)
        found = part if found is None else found.unionByName(part)
    return found


def containment_qrels(queries: DataFrame, corpus: DataFrame, index: LexicalIndex | None = None,
                      query_col: str = "query", materialize: bool = True) -> DataFrame:
    """query_id, doc_id for every document whose text contains the query text.

    Null and empty passages match nothing. The judgement table is small and
    read by several consumers (flags, relevant counts, missing documents), so
    it is written once by default.
    """
    index = index or build_index(corpus, keep_text=True)
    q = queries.select("query_id", F.col(query_col).alias("passage")).where(
        F.col("passage").isNotNull() & (F.length("passage") > 0))
    q = q.withColumn("terms", F.array_distinct(interior_terms("passage")))
    docs = corpus.select("doc_id", "text")
    cand = _term_candidates(q.where(F.size("terms") > 0), index, materialize)
    passages = _small(q.select("query_id", "passage"))
    if index.texts is not None:
        # both lie in the same shards: each shard's few candidates are hashed, and its texts stream past them
        met = index.texts.join(cand.hint("shuffle_hash"), "doc_id")
    else:
        cand = _materialize(cand, "containment-candidates") if materialize else cand
        met = docs.join(_small(cand), "doc_id")
    hits = met.join(passages, "query_id").where(F.col("text").contains(F.col("passage"))).select("query_id", "doc_id")
    keyless = q.where(F.size("terms") == 0).select("query_id", "passage")
    if not keyless.isEmpty():
        hits = hits.unionByName(multi_contains(index.texts if index.texts is not None else docs, keyless))
    return _materialize(hits, "qrels") if materialize else hits


def judged_table(queries: DataFrame, qrels: DataFrame, corpus: DataFrame) -> DataFrame:
    """Queries JOIN qrels JOIN docs + query_docs (judged rows per query).

    query_id, query, doc_id, text, query_docs. Queries without judgements drop out.
    """
    j = qrels.select("query_id", "doc_id").distinct()
    # per-query counts by aggregation (map-side combine), not a window: one
    # query may hold a third of all judgements
    counts = j.groupBy("query_id").agg(F.count(F.lit(1)).alias("query_docs"))
    merged = (queries.select("query_id", "query").join(j, "query_id")
              .join(corpus.select("doc_id", "text"), "doc_id").join(counts, "query_id"))
    return merged.select("query_id", "query", "doc_id", "text", "query_docs")
