"""M1: incremental corpus ingest with Structured Streaming.

New documents arrive as files; every micro-batch (``foreachBatch``):
  1. keeps one row per doc_id within the batch and drops doc_ids that earlier
     batches hold: an anti-join with the id table, which is bucketed by doc_id,
     so only the batch's ids are shuffled, and pruned by the batch's smallest and
     largest id (a streaming dropDuplicates without watermark would keep unbounded
     state);
  2. writes the new documents once; postings, doc stats, statistic deltas, vectors
     and sketches are derived from that written table;
  3. commits: one row in ``commits/batch_id=<n>`` makes all tables of the batch
     visible together.
Everything lies in ``batch_id=<n>`` partitions that a replayed batch overwrites,
and readers see committed batches only, so a batch that failed half-way or comes
again changes nothing. Document frequencies, N and total length are stored as
per-batch deltas and summed when the index is read; distinct counts are stored as
mergeable sketches. :func:`compact_index` folds the batches.

Ids may be whole numbers or strings; a root holds one kind.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rankfold.operators.encode import hash_vectors
from rankfold.operators.lexical import LexicalIndex, build_index, observed
from rankfold.operators.vector_store import VectorStore
from rankfold.session import checkpoint_path, path_exists

DOC_SCHEMA = "doc_id LONG, text STRING"
ID_BUCKETS = 64
#: Bits of a distinct-count sketch: its relative standard error is about 1.04 / sqrt(2 ** bits).
SKETCH_BITS = 12


def _part(root: str, table: str, batch_id: int) -> str:
    return os.path.join(root, table, f"batch_id={batch_id}")


def committed(spark: SparkSession, root: str) -> tuple[int, ...]:
    """The ids of the batches whose tables are visible (one number a batch)."""
    path = os.path.join(root, "commits")
    if not path_exists(spark, path):
        return ()
    return tuple(sorted(r[0] for r in spark.read.parquet(path).select("batch_id").distinct().collect()))


def _with_vectors(spark: SparkSession, root: str, batches: tuple[int, ...]) -> tuple[int, ...]:
    """Those of some committed batches that hold vectors."""
    if not batches:
        return ()
    rows = spark.read.parquet(os.path.join(root, "commits")).where(F.col("batch_id").isin(*batches) & F.col("vectors"))
    return tuple(sorted(r[0] for r in rows.select("batch_id").distinct().collect()))


def _ids_table(spark: SparkSession, root: str, kind: str) -> str:
    """The catalogue's name of the id table under ``root``: bucketed by doc_id, partitioned by batch."""
    name = f"rankfold_ids_{hashlib.md5(root.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"""CREATE TABLE {name} (doc_id {kind}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id)
            CLUSTERED BY (doc_id) INTO {ID_BUCKETS} BUCKETS LOCATION '{os.path.join(root, "doc_ids")}'""")
        if path_exists(spark, os.path.join(root, "doc_ids")):  # another session may have written batches
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def new_documents(batch: DataFrame, batch_id: int, root: str) -> DataFrame:
    """doc_id, text of the batch's documents that no other committed batch holds."""
    spark = batch.sparkSession
    docs = batch.select("doc_id", "text").where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    others = [b for b in committed(spark, root) if b != batch_id]
    if not others:
        return docs
    low, high = batch.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        return docs
    seen = spark.table(_ids_table(spark, root, docs.schema["doc_id"].dataType.simpleString()))
    seen = seen.where(F.col("batch_id").isin(*others) & F.col("doc_id").between(low, high)).select("doc_id")
    return docs.join(seen, "doc_id", "left_anti")


def ingest_batch(batch: DataFrame, batch_id: int, root: str, with_vectors: bool = True) -> dict[str, int]:
    """Index one micro-batch; returns its profile: rows and bytes that were new, counted while they were written."""
    spark = batch.sparkSession
    docs = new_documents(batch, batch_id, root)
    seen = Observation(f"ingest {batch_id}")
    counted = docs.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    counted.write.mode("overwrite").parquet(_part(root, "docs", batch_id))
    profile = observed(seen, "rows", "bytes")
    docs = spark.read.schema(docs.schema).parquet(_part(root, "docs", batch_id))  # written once, read from here on

    ids = _ids_table(spark, root, docs.schema["doc_id"].dataType.simpleString())
    docs.select("doc_id").createOrReplaceTempView(f"{ids}_new")
    spark.sql(f"INSERT OVERWRITE TABLE {ids} PARTITION (batch_id = {int(batch_id)}) SELECT doc_id FROM {ids}_new")

    idx = build_index(docs, materialize=False)
    idx.postings.write.mode("overwrite").parquet(_part(root, "postings", batch_id))
    post = spark.read.schema(idx.postings.schema).parquet(_part(root, "postings", batch_id))
    terms = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms.write.mode("overwrite").parquet(_part(root, "term_deltas", batch_id))
    stats = post.groupBy("doc_id").agg(F.max("dl").alias("dl"), F.count(F.lit(1)).alias("n_terms"))
    stats.write.mode("overwrite").parquet(_part(root, "doc_stats", batch_id))
    total = post.select(F.coalesce(F.sum("tf"), F.lit(0)).cast("long")).scalar()
    (spark.range(1).select(F.lit(profile["rows"]).cast("long").alias("n_docs"), total.alias("total_len"))
     .coalesce(1).write.mode("overwrite").parquet(_part(root, "corpus_deltas", batch_id)))
    sketch = lambda df, c: df.agg(F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias("sketch")).select(F.lit(c).alias("counted"), "sketch")
    (sketch(post, "term").unionByName(sketch(docs, "doc_id")).coalesce(1).write.mode("overwrite").parquet(_part(root, "sketches", batch_id)))

    if with_vectors and profile["rows"]:
        others = tuple(b for b in committed(spark, root) if b != batch_id)
        store = VectorStore(spark, os.path.join(root, "vectors"), batches=_with_vectors(spark, root, others))
        vectors = hash_vectors(post, docs)
        store.fit(vectors)
        store.append(vectors, batch_id, commit=False)
    (spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in profile.items()], F.lit(bool(with_vectors and profile["rows"])).alias("vectors"))
     .coalesce(1).write.mode("overwrite").parquet(_part(root, "commits", batch_id)))
    return profile


def start_ingest(spark: SparkSession, source_dir: str, root: str, checkpoint: str | None = None,
                 max_files_per_trigger: int = 1, available_now: bool = True, schema: str = DOC_SCHEMA, with_vectors: bool = True):
    """Start the ingest stream over parquet files of (doc_id, text) in ``source_dir``."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source_dir))

    def ingest(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, root, with_vectors)

    w = (stream.writeStream.foreachBatch(ingest)
         .option("checkpointLocation", checkpoint or os.path.join(root, "_stream_checkpoint")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


@dataclass(frozen=True)
class Snapshot:
    """The ingested corpus as of some batches: later batches stay invisible to whoever holds it."""

    spark: SparkSession
    root: str
    batches: tuple[int, ...]

    def _read(self, table: str) -> DataFrame:
        if not self.batches:
            raise ValueError(f"no batch is committed under {self.root}")
        return self.spark.read.parquet(os.path.join(self.root, table)).where(F.col("batch_id").isin(*self.batches)).drop("batch_id")

    def documents(self) -> DataFrame:
        """doc_id, text."""
        return self._read("docs")

    def index(self) -> LexicalIndex:
        """The lexical index, its deltas summed."""
        term_stats = self._read("term_deltas").groupBy("term").agg(F.sum("df").cast("long").alias("df"))
        d = self._read("corpus_deltas").agg(F.sum("n_docs").cast("long").alias("n_docs"), F.sum("total_len").cast("long").alias("total_len"))
        corpus_stats = d.withColumn("avgdl", F.try_divide(F.col("total_len").cast("double"), F.col("n_docs").cast("double")))
        return LexicalIndex(self._read("postings").select("term", "doc_id", "dl", "tf"), term_stats, corpus_stats, self._read("doc_stats"),
                            profile=self.profile())

    def vectors(self) -> VectorStore:
        """The stored hash vectors of the same batches."""
        return VectorStore(self.spark, os.path.join(self.root, "vectors"), batches=_with_vectors(self.spark, self.root, self.batches))

    def profile(self) -> dict[str, int]:
        """Rows and bytes of all batches, from what each observed."""
        r = self._read("commits").agg(F.sum("rows"), F.sum("bytes")).first()
        return {"rows": r[0], "bytes": r[1]}

    def distinct_counts(self) -> DataFrame:
        """counted ('term' or 'doc_id'), estimate: the batches' sketches merged, without reading what they count."""
        return self._read("sketches").groupBy("counted").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The ingested corpus as of now."""
    return Snapshot(spark, root, committed(spark, root))


def load_ingested_index(spark: SparkSession, root: str) -> LexicalIndex:
    """The index as of the last committed batch."""
    return snapshot(spark, root).index()


def compact_index(spark: SparkSession, root: str, out: str) -> LexicalIndex:
    """Fold all batches into one plain index folder (see ``lexical.save_index``)."""
    from rankfold.operators.lexical import load_index, save_index

    save_index(load_ingested_index(spark, root), out)
    return load_index(spark, out)


def stage_files(df: DataFrame, name: str, n_files: int) -> str:
    """Lay a table out as ``n_files`` parquet files in the shared folder (stream input)."""
    import uuid

    path = checkpoint_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.repartition(n_files).write.parquet(path)
    return path
