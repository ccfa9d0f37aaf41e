"""M2: answer a stream of queries against a pinned snapshot of the index.

Ranking windows cannot run on a streaming DataFrame directly, so every
micro-batch of queries is answered as a batch job inside ``foreachBatch``
and written to its own ``batch_id=<n>`` partition (overwritten on replay).
The snapshot is taken when the stream starts: batches ingested while it runs
don't change its answers, and a replayed batch of queries gets the same ones.

A retriever is any function from a batch of queries (query_id, query) to a ranked
list; ``lexical``, ``hashed`` (stored hash vectors) and ``fused`` (reciprocal rank
fusion of both) are built in.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rankfold.operators.encode import hash_vectors
from rankfold.operators.lexical import LexicalIndex, bm25_search, query_terms
from rankfold.operators.rank import rrf_two
from rankfold.operators.vector_store import VectorStore
from rankfold.session import materialize
from rankfold.streaming.ingest import Snapshot

QUERY_SCHEMA = "query_id LONG, query STRING"
Retriever = Callable[[DataFrame], DataFrame]


def lexical(index: LexicalIndex, k: int = 10) -> Retriever:
    return lambda queries: bm25_search(queries, index, k=k)


def hashed(store: VectorStore, k: int = 10) -> Retriever:
    """Nearest stored vectors of the queries' own hash vectors."""
    store = store.pinned()

    def answer(queries: DataFrame) -> DataFrame:
        vectors = hash_vectors(query_terms(queries), queries, "query_id", "qtf")
        return store.search(vectors, k)

    return answer


def fused(a: Retriever, b: Retriever) -> Retriever:
    """The lists of two retrievers fused; a batch of queries is written once for both."""
    def answer(queries: DataFrame) -> DataFrame:
        queries = materialize(queries.select("query_id", "query"), "query-batch")
        return rrf_two(a(queries), b(queries))

    return answer


def snapshot_retriever(snapshot: Snapshot, k: int = 10) -> Retriever:
    """BM25 and stored hash vectors of one snapshot, fused."""
    return fused(lexical(snapshot.index(), k), hashed(snapshot.vectors(), k))


def start_answering(spark: SparkSession, source_dir: str, index: LexicalIndex | Retriever, out_dir: str, k: int = 10,
                    checkpoint: str | None = None, max_files_per_trigger: int = 1, available_now: bool = True,
                    schema: str = QUERY_SCHEMA):
    """Start answering queries from parquet files in ``source_dir``; ``index``: a lexical index, or a retriever."""
    retrieve = lexical(index, k) if isinstance(index, LexicalIndex) else index
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))

    def answer(batch: DataFrame, batch_id: int) -> None:
        retrieve(batch).write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    w = (stream.writeStream.foreachBatch(answer)
         .option("checkpointLocation", checkpoint or os.path.join(out_dir, "_stream_checkpoint")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_answers(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(out_dir).drop("batch_id")
