"""A stored vector table in cells, appended in batches, searched exactly.

Layout under one folder:
  centres/                                   cell_id, centre        (fitted once, on a bounded sample)
  vectors/batch_id=<b>/cell_id=<c>/          doc_id, embedding
  cells/batch_id=<b>/                        cell_id, n, lo, hi     (smallest and largest distance to the centre)
  ids/batch_id=<b>/                          doc_id
  commits/batch_id=<b>/                      n                      (written last: the batch becomes visible)

``append`` overwrites its own batch's folders, leaves out ids that other visible
batches hold, and commits last, so a batch that is replayed or that failed
half-way changes nothing but itself.

Search is exact. For a query q and a cell with centre c whose vectors lie
between lo and hi from c, the triangle inequality gives a distance of at least
max(0, |q - c| - hi, lo - |q - c|). The cells nearest to a query that hold k
vectors are searched first; the k-th distance found there bounds the answer, and
only cells whose lower bound doesn't exceed it are searched as well. The vectors
of cells that no query needs are never read (the folders are pruned while the
job runs). A first task searches a block of one cell's vectors for a block of the
queries that need the cell, so a cell holding a third of all vectors is many
tasks, and queries travel to cells, not to every block. For the second part, in
which a query may need every cell (vectors without clusters), neighbouring cells
lie together in groups: a query travels once to each group that it needs, with
its cells as bits of one number and its k-th distance so far, and a group's
vectors travel once to each block of the queries that need it.

``metric='cosine'`` keeps the cells of the unit vectors; on these, squared
distance is 2 - 2 cosine, so the same bounds hold. A zero vector has cosine 0;
its bound only lets more cells in.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankfold.operators.rank import top_k
from rankfold.operators.vectors import GRID_DOC_BLOCK, GRID_QUERY_BLOCK, TILE_ROWS, _arrow_matrix, answer_ddl, search_blocks
from rankfold.schemas import require_columns
from rankfold.session import checkpoint_path, materialize, path_exists

#: Vectors the centres are fitted on (smallest id hashes), and cells at most: the centres are broadcast.
SAMPLE, MAX_CELLS = 20_000, 1_024
ROUNDS = 8
#: Rows of one cell's file; a larger cell is written by several tasks.
FILE_ROWS = 200_000
#: Cells of a group at most: one bit each of a whole number.
GROUP_CELLS = 63


def _unit(x: np.ndarray, metric: str) -> np.ndarray:
    if metric != "cosine":
        return x
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of every vector, some vectors at once."""
    return np.concatenate([np.zeros(0, np.int64), *(_distances(x[i:i + TILE_ROWS], centres).argmin(1) for i in range(0, len(x), TILE_ROWS))])


def fit_centres(sample: np.ndarray, n_cells: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """k-means by Lloyd's rounds from distinct starting vectors; cells left empty are dropped."""
    distinct = np.unique(sample, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.choice(len(distinct), min(n_cells, len(distinct)), replace=False)]
    for _ in range(rounds):
        own = _nearest(sample, centres)
        n = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = sums[n > 0] / n[n > 0, None]
    return centres


def group_cells(centres: np.ndarray, n: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Group and place in it of every cell: neighbouring cells of at most ``rows`` rows together, one cell at least."""
    group, place = np.zeros(len(n), np.int32), np.zeros(len(n), np.int32)
    left, at, g, p, held = np.ones(len(n), bool), 0, -1, 0, 0
    for i in range(len(n)):
        if i == 0 or p + 1 == GROUP_CELLS or held + n[at] > rows:
            g, p, held = g + 1, 0, 0
        else:
            p += 1
        group[at], place[at], held, left[at] = g, p, held + n[at], False
        if left.any():
            away = _distances(centres[at:at + 1], centres)[0]
            at = int(np.where(left, away, np.inf).argmin())
    return group, place


def _cells_of(x: np.ndarray, table: tuple, metric: str, home: bool, need: int, reach: np.ndarray | None):
    """(vectors x cells) booleans: the nearest cells that hold ``need`` vectors at home, else all others within ``reach``; the nearest cell."""
    centres, ids, n, lo, hi = table
    away = _distances(_unit(x, metric), centres[ids])
    order = np.argsort(away, axis=1, kind="stable")
    before = np.cumsum(n[order], axis=1) - n[order]
    near = np.zeros(away.shape, bool)
    np.put_along_axis(near, order, before < need, axis=1)
    if not home:
        low = np.maximum(0.0, np.maximum(away - hi, lo - away))
        near = ~near & (low <= reach[:, None] + 1e-7 * (1.0 + away))
    return near, order[:, 0]


@dataclass(frozen=True)
class VectorStore:
    """A store at ``path``. ``batches``: the visible batches, by default those committed here."""

    spark: SparkSession
    path: str
    metric: str = "l2"
    batches: tuple[int, ...] | None = None

    # ------------------------------------------------------------ reading

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def committed(self) -> tuple[int, ...]:
        """The ids of the visible batches (one number a batch)."""
        if self.batches is not None:
            return self.batches
        if not path_exists(self.spark, self._at("commits")):
            return ()
        return tuple(sorted(r[0] for r in self.spark.read.parquet(self._at("commits")).select("batch_id").distinct().collect()))

    def pinned(self) -> VectorStore:
        """The same store as of now: later batches stay invisible."""
        return VectorStore(self.spark, self.path, self.metric, self.committed())

    def _read(self, table: str) -> DataFrame:
        seen = self.committed()
        if not seen:
            raise ValueError(f"the vector store at {self.path} has no committed batch")
        return self.spark.read.parquet(self._at(table)).where(F.col("batch_id").isin(*seen))

    def vectors(self) -> DataFrame:
        """doc_id, embedding, cell_id."""
        return self._read("vectors").select("doc_id", "embedding", "cell_id")

    def cells(self) -> DataFrame:
        """cell_id, n, lo, hi over the visible batches."""
        return self._read("cells").groupBy("cell_id").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def count(self) -> int:
        return self._read("cells").agg(F.sum("n")).first()[0] or 0 if self.committed() else 0

    def centres(self) -> np.ndarray:
        t = self.spark.read.parquet(self._at("centres")).orderBy("cell_id").toArrow()  # at most MAX_CELLS rows
        return _arrow_matrix(t.column("centre").combine_chunks(), None)

    # ------------------------------------------------------------ writing

    def fit(self, vectors: DataFrame, n_cells: int | None = None, sample: int = SAMPLE) -> None:
        """Fit and store the centres, unless the store has them."""
        if path_exists(self.spark, self._at("centres", "_SUCCESS")):
            return
        if n_cells is None:
            n_cells = max(1, round(vectors.count() ** 0.5))
        some = vectors.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("embedding").toArrow()
        x = _arrow_matrix(some.column("embedding").combine_chunks(), None)
        if not len(x):
            raise ValueError("no vectors to fit the cells on")
        centres = fit_centres(_unit(x, self.metric), min(n_cells, MAX_CELLS))
        rows = [(i, c.tolist()) for i, c in enumerate(centres)]
        (self.spark.createDataFrame(rows, "cell_id int, centre array<double>").coalesce(1)
         .write.mode("overwrite").parquet(self._at("centres")))

    def append(self, vectors: DataFrame, batch_id: int, commit: bool = True) -> int:
        """Add (doc_id, embedding) rows as batch ``batch_id``; returns how many were new.

        Of rows with equal ids one stays; ids of other visible batches are left out. ``commit=False`` leaves
        the batch invisible until ``commit`` (or a commit list of the caller's own).
        """
        require_columns(vectors, "doc_id", "embedding", what="vectors")
        x = vectors.select("doc_id", "embedding").groupBy("doc_id").agg(F.min("embedding").alias("embedding"))
        others = [b for b in self.committed() if b != batch_id]
        if others:
            held = self.spark.read.parquet(self._at("ids")).where(F.col("batch_id").isin(*others)).select("doc_id")
            x = x.join(held, "doc_id", "left_anti")
        ddl = f"doc_id {x.schema['doc_id'].dataType.simpleString()}, embedding {x.schema['embedding'].dataType.simpleString()}, cell_id int, away double"
        centres, metric = self.spark.sparkContext.broadcast(self.centres()), self.metric
        target = to_arrow_schema(StructType.fromDDL(ddl))

        def assign(batches):
            c = centres.value
            for b in batches:
                if not b.num_rows:
                    continue
                v = _unit(_arrow_matrix(b.column(1), c.shape[1]), metric)
                own = _nearest(v, c)
                away = np.sqrt(((v - c[own]) ** 2).sum(1))
                cols = [b.column(0), b.column(1), pa.array(own, pa.int32()), pa.array(away)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(cols, target)], schema=target)

        x = materialize(x.mapInArrow(assign, ddl), "store-assigned")
        batch = f"batch_id={batch_id}"
        stats = x.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("lo"), F.max("away").alias("hi"))
        stats.coalesce(1).write.mode("overwrite").parquet(self._at("cells", batch))
        x.select("doc_id").write.mode("overwrite").parquet(self._at("ids", batch))
        sizes = self.spark.read.parquet(self._at("cells", batch)).select("cell_id", F.ceil(F.col("n") / FILE_ROWS).alias("files"))
        spread = x.join(F.broadcast(sizes), "cell_id").withColumn("file", F.pmod(F.xxhash64("doc_id"), F.col("files")))
        (spread.repartition("cell_id", "file").select("doc_id", "embedding", "cell_id")
         .write.mode("overwrite").partitionBy("cell_id").parquet(self._at("vectors", batch)))
        n = x.count()
        if commit:
            self.commit(batch_id, n)
        return n

    def commit(self, batch_id: int, n: int) -> None:
        self.spark.range(1).select(F.lit(n).cast("long").alias("n")).coalesce(1).write.mode("overwrite").parquet(
            self._at("commits", f"batch_id={batch_id}"))

    # ------------------------------------------------------------ search

    def _wanted(self, queries: DataFrame, cells: np.ndarray, table: tuple, home: bool, need: int) -> DataFrame:
        """query_id, embedding, cell_id: the cells a query needs, nearest first at home, else all within ``reach``."""
        spark, metric = self.spark, self.metric
        shared = spark.sparkContext.broadcast((cells, *table))
        kinds = [queries.schema[c].dataType.simpleString() for c in ("query_id", "embedding")]
        ddl = f"query_id {kinds[0]}, embedding {kinds[1]}, cell_id int"
        target = to_arrow_schema(StructType.fromDDL(ddl))

        def run(batches):
            centres, ids = shared.value[:2]
            for whole in batches:
                for start in range(0, whole.num_rows, TILE_ROWS):  # all cells of few queries at once
                    b = whole.slice(start, TILE_ROWS)
                    reach = None if home else b.column(2).to_numpy(zero_copy_only=False)
                    near, _ = _cells_of(_arrow_matrix(b.column(1), centres.shape[1]), shared.value, metric, home, need, reach)
                    row, cell = np.nonzero(near)
                    cols = [b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(ids[cell], pa.int32())]
                    yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(cols, target)], schema=target)

        cols = ["query_id", "embedding", *([] if home else ["reach"])]
        return materialize(queries.select(*cols).mapInArrow(run, ddl), "store-wanted")

    def needed(self, wanted: DataFrame, query_block: int, doc_block: int) -> DataFrame:
        """cell_id, queries, query_blocks, doc_blocks of the cells that some query wants (written: a row a cell)."""
        asked = wanted.groupBy("cell_id").agg(F.count(F.lit(1)).alias("queries"))
        return materialize(self.cells().join(asked, "cell_id").select(
            "cell_id", "queries", F.ceil(F.col("queries") / query_block).cast("int").alias("query_blocks"),
            F.ceil(F.col("n") / doc_block).cast("int").alias("doc_blocks")), "store-needed")

    def _search_cells(self, wanted: DataFrame, need: DataFrame, ddl: str, k, metric, squared, exclude_self, digits) -> DataFrame:
        cells = F.broadcast(need.where("queries > 0"))  # at most MAX_CELLS rows; the filter lets it prune the cells' folders
        q = wanted.join(cells, "cell_id").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("query_blocks")))
        q = q.withColumn("db", F.explode(F.sequence(F.lit(0), F.col("doc_blocks") - 1)))
        d = self.vectors().join(cells, "cell_id").withColumn("db", F.pmod(F.xxhash64("doc_id"), F.col("doc_blocks")).cast("int"))
        d = d.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        q = q.select("cell_id", F.col("qb").cast("long").alias("qb"), F.col("db").cast("int").alias("db"), "query_id", "embedding")
        d = d.select("cell_id", F.col("qb").cast("long").alias("qb"), "db", "doc_id", "embedding")
        return search_blocks(q, d, ["cell_id", "qb", "db"], ddl, k, metric, squared, exclude_self, digits)

    def _asked(self, queries: DataFrame, cells: np.ndarray, table: tuple, groups: tuple, need: int) -> DataFrame:
        """query_id, embedding, last, home, grp, wants: a row for each group that holds cells within a query's ``reach``.

        ``wants`` has the bits of these cells, without those searched at home; ``home`` is the nearest cell's group.
        """
        shared, metric = self.spark.sparkContext.broadcast((cells, *table)), self.metric
        kinds = [queries.schema[c].dataType.simpleString() for c in ("query_id", "embedding")]
        ddl = f"query_id {kinds[0]}, embedding {kinds[1]}, last double, home int, grp int, wants long"
        target = to_arrow_schema(StructType.fromDDL(ddl))
        group, place = groups
        bits = np.left_shift(np.int64(1), place.astype(np.int64))

        def run(batches):
            centres = shared.value[0]
            for whole in batches:
                for start in range(0, whole.num_rows, TILE_ROWS):
                    b = whole.slice(start, TILE_ROWS)
                    reach = b.column(2).to_numpy(zero_copy_only=False)
                    near, first = _cells_of(_arrow_matrix(b.column(1), centres.shape[1]), shared.value, metric, False, need, reach)
                    for g in range(int(group.max()) + 1):
                        wants = near[:, group == g] @ bits[group == g]
                        row = pa.array(np.flatnonzero(wants))
                        some = b.take(row) if len(row) else b.slice(0, 0)
                        cols = [some.column(0), some.column(1), some.column(3), pa.array(group[first[row]]),
                                pa.array(np.full(len(row), g, np.int32)), pa.array(wants[row])]
                        yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(cols, target)], schema=target)

        return materialize(queries.select("query_id", "embedding", "reach", "last").mapInArrow(run, ddl), "store-asked")

    def _search_groups(self, queries: DataFrame, cells: np.ndarray, table: tuple, need: int, ddl: str, k, metric, squared, exclude_self,
                       digits, query_block: int, doc_block: int) -> DataFrame:
        """The top-k of the cells within each query's ``reach`` that were not searched at home."""
        ids, n = table[:2]
        groups = group, place = group_cells(cells[ids], n, doc_block)
        asked = self._asked(queries, cells, table, groups, need)
        pairs = materialize(asked.groupBy("home", "grp").agg(  # a row a pair of groups
            F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("query_blocks"), F.expr("bit_or(wants)").alias("any")), "store-pairs")
        rows = np.bincount(group, n).astype(np.int64)
        places = self.spark.createDataFrame(
            [(int(i), int(g), int(p), int(-(-rows[g] // doc_block))) for i, g, p in zip(ids, group, place)], "cell_id int, grp int, part int, doc_blocks int")
        q = asked.join(F.broadcast(pairs.drop("any")), ["home", "grp"]).join(F.broadcast(places.select("grp", "doc_blocks").distinct()), "grp")
        q = q.withColumn("qb", F.pmod(F.xxhash64("query_id", "embedding"), F.col("query_blocks")).cast("int"))
        q = q.withColumn("db", F.explode(F.sequence(F.lit(0), F.col("doc_blocks") - 1)))
        wanted = materialize(pairs.join(places, "grp").where(F.expr("shiftright(any, part) & 1 = 1")).drop("any"), "store-needed")
        d = self.vectors().join(F.broadcast(wanted.where("query_blocks > 0")), "cell_id")
        d = d.withColumn("db", F.pmod(F.xxhash64("doc_id"), F.col("doc_blocks")).cast("int"))
        d = d.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
        by = ["grp", "home", "qb", "db"]
        return search_blocks(q.select(*by, "query_id", "embedding", "last", "wants"), d.select(*by, "doc_id", "embedding", "part"), by, ddl,
                             k, metric, squared, exclude_self, digits)

    def search(self, queries: DataFrame, k: int = 10, squared: bool = True, exclude_self: bool = False, digits: int = 6,
               query_block: int = GRID_QUERY_BLOCK, doc_block: int = GRID_DOC_BLOCK) -> DataFrame:
        """Exact top-k per query: query_id, doc_id, score, rnk; the same answers as ``vectors.knn_search``."""
        require_columns(queries, "query_id", "embedding", what="query vectors")
        store = self.pinned()
        metric, centres = store.metric, store.centres()
        t = store.cells().orderBy("cell_id").toArrow()  # a row a cell
        table = tuple(t.column(c).to_numpy() for c in ("cell_id", "n", "lo", "hi"))
        queries = materialize(queries.select("query_id", "embedding"), "store-queries")
        ddl = answer_ddl(queries, store.vectors())
        args = (ddl, k, metric, squared, exclude_self, digits)
        enough = k + int(exclude_self)
        home = store._wanted(queries, centres, table, True, enough)
        first = top_k(store._search_cells(home, store.needed(home, query_block, doc_block), *args), k, descending=metric == "cosine")
        first = materialize(first.drop("rnk"), "store-home")
        last = first.groupBy("query_id").agg((F.min if metric == "cosine" else F.max)("score").alias("last"), F.count(F.lit(1)).alias("found"))
        step = 10.0 ** -digits  # scores are rounded: what rounds to the k-th score may still tie with it
        if metric == "cosine":
            reach = F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * (F.col("last") - step)))
        else:
            reach = F.sqrt(F.col("last") + step) if squared else F.col("last") + step
        reach = F.when(F.col("found") >= k, reach).otherwise(F.lit(float("inf")))
        last = last.select("query_id", reach.alias("reach"), F.when(F.col("found") >= k, F.col("last")).alias("last"))
        asked = queries.join(last, "query_id", "left").fillna(float("inf"), subset=["reach"])
        more = store._search_groups(asked, centres, table, enough, *args, query_block, doc_block)
        return top_k(first.unionByName(more), k, descending=metric == "cosine")


def create(vectors: DataFrame, path: str | None = None, metric: str = "l2", n_cells: int | None = None) -> VectorStore:
    """A store fitted on ``vectors`` (none of them is added yet); a scratch folder without ``path``."""
    spark = vectors.sparkSession
    store = VectorStore(spark, path or checkpoint_path(spark, f"vector-store-{uuid.uuid4().hex}"), metric)
    store.fit(vectors, n_cells)
    return store


def search_once(queries, docs, k, metric, squared, exclude_self, digits, query_block, doc_block) -> DataFrame:
    """``knn_search`` by cells: the documents are laid out in a scratch store first."""
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], answer_ddl(queries, docs) + ", rnk int")
    store = create(docs, metric=metric)
    store.append(docs, 0)
    return store.search(queries, k, squared, exclude_self, digits, query_block, doc_block)
