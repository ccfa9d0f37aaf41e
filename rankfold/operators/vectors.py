"""Exact k-nearest-neighbour search (squared L2, L2, cosine).

No (query, document) pair is ever a row. A task computes lower bounds of the
distances in tiles of ``TILE_ROWS`` queries and ``TILE_COLS`` documents (one
matrix product in float32, whose proven error is taken off in the product
itself), recomputes exactly in float64 what can still be among the k nearest
found so far, and keeps k answers a query, so it emits at most k rows per query
whatever the batch size. Documents are met by rising id: once a query has k
answers, equal distances no longer make candidates, so groups of equal vectors
cost no more than others. A vector with a component that is no finite number
answers nothing.

Strategies:
  * ``broadcast``: the query matrix (at most ``MAX_BROADCAST_BYTES``, checked also when the
    strategy is asked for) is shipped to every task, documents are scanned where they lie -
    no shuffle of the corpus. Taken for few queries, whose answers are few as well: each task
    holds the k best of every query.
  * ``grid``: queries and documents are hashed into blocks; each (query-block, doc-block) cell is
    one cogroup task; memory per task is bounded by the block sizes, which are parameters. Every
    pair of blocks meets, whatever the vectors. Taken beyond ``broadcast`` while the documents are
    one block.
  * ``stream``: beyond that, all documents pass every block of queries by rising id. A task holds
    its queries and their k best, and a tile of documents at a time; its lists are the answers.
    (Blocks of documents as well, merged by a final top-k, only where the queries' blocks are
    fewer than the cores.)
  * ``cells``: the documents are laid out in cells and only the cells that can hold an answer are
    searched (see ``vector_store``): for clustered vectors; a corpus that is searched more than
    once is better kept as a store.

The lists of ``broadcast`` and ``grid`` are merged by a final per-query top-k (partial + final
WindowGroupLimit). Ids may be whole numbers or strings.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankfold.operators.rank import top_k
from rankfold.schemas import require_columns
from rankfold.session import table_size

MAX_BROADCAST_BYTES = 16 * 1024 * 1024  # query matrix shipped to every task (float64)
MAX_BROADCAST_ANSWERS = 500_000  # queries x k: the running lists of every task
GRID_QUERY_BLOCK = 16_384
GRID_DOC_BLOCK = 65_536
STREAM_QUERIES, STREAM_ANSWERS = 32_768, 4_000_000  # queries, and queries x k, of a block that all documents pass
STREAM_LEAST = 4_096  # queries of such a block at least: each block costs a copy of the documents
TILE_ROWS, TILE_COLS = 512, 4_096  # distances computed at once in a task
_CANDIDATES = 8_192  # candidates recomputed exactly at once
_SINGLE = 1e30  # squared norms up to which products fit float32


def answer_ddl(queries: DataFrame, docs: DataFrame) -> str:
    """The schema of (query_id, doc_id, score) for these tables' ids."""
    kinds = [df.select(c).schema[0].dataType.simpleString() for df, c in ((queries, "query_id"), (docs, "doc_id"))]
    return f"query_id {kinds[0]}, doc_id {kinds[1]}, score double"


def _ids(col) -> np.ndarray:
    """Ids of an Arrow column: int64, or objects for strings."""
    if pa.types.is_integer(col.type):
        return col.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.array(col.to_pylist(), dtype=object)


def _order(ids: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the ids."""
    return ids if ids.dtype != object else np.unique(ids, return_inverse=True)[1]


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def answer_batch(parts: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    """(query ids, doc ids, scores and, if the target has them, ranks) parts as one Arrow batch."""
    cols = [np.concatenate(c) for c in zip(*parts)] if parts else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, target)], schema=target)


def _arrow_matrix(col, dim: int | None) -> np.ndarray:
    """(n, dim) float64 from an Arrow list column, without per-row Python objects."""
    import pyarrow.compute as pc

    n = len(col)
    if n == 0:
        return np.zeros((0, dim or 0))
    lens = pc.list_value_length(col).to_numpy(zero_copy_only=False)
    width = int(lens[0]) if dim is None else dim
    if (lens != width).any():
        raise ValueError(f"vector length mismatch: found lengths {sorted(set(lens.tolist()))}, expected {width}")
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, width)


def _norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return (x * x).sum(1)


def _slack(dim: int, kind) -> float:
    """The error of a tile's distance, as a part of |q|^2 + |d|^2 (of 1 for unit vectors): over twice what rounding can do."""
    return (2 * dim + 16) * float(np.finfo(kind).eps)


def _side(x: np.ndarray, norm: np.ndarray, metric: str, kind, query: bool) -> np.ndarray:
    """One side of a tile's matrix product, whose values are at most the squared distance (the negative cosine)."""
    slack, one = _slack(x.shape[1], kind), np.ones(len(x))
    if metric == "cosine":
        unit = np.divide(x, np.sqrt(norm)[:, None], out=np.zeros_like(x), where=norm[:, None] != 0)
        cols = (-unit, -slack * one) if query else (unit, one)
    else:
        cols = (-2.0 * x, (1 - slack) * norm, one) if query else (x, one, (1 - slack) * norm)
    return np.column_stack(cols).astype(kind)


class _Docs:
    """Documents by rising id, ready for many tiles of queries; without vectors that are no finite numbers."""

    def __init__(self, ids, D, metric, part=None):
        norm = _norms(D)
        if not (ok := np.isfinite(norm)).all():
            ids, D, norm, part = ids[ok], D[ok], norm[ok], None if part is None else part[ok]
        self.ids, self.D, self.norm, self.part, self.metric, self.sides = ids, D, norm, part, metric, {}
        self.most = norm.max(initial=0)

    def side(self, kind) -> np.ndarray:
        if kind not in self.sides:
            self.sides[kind] = _side(self.D, self.norm, self.metric, kind, False)
        return self.sides[kind]

    def tiles(self, some: np.ndarray | None = None):
        """Tiles of all documents, or of those at the places ``some``."""
        self.side(np.float32 if self.most < _SINGLE else np.float64)  # once for all tiles
        for t in range(0, len(self.ids) if some is None else len(some), TILE_COLS):
            c = slice(t, t + TILE_COLS) if some is None else some[t:t + TILE_COLS]
            docs = object.__new__(_Docs)
            docs.ids, docs.D, docs.norm, docs.metric = self.ids[c], self.D[c], self.norm[c], self.metric
            docs.part, docs.most = None if self.part is None else self.part[c], docs.norm.max(initial=0)
            docs.sides = {kind: x[c] for kind, x in self.sides.items()}
            yield docs


class _Tile:
    """A tile of queries with the k best documents of those met so far. Documents must come by rising id.

    ``last``: per query a k-th score that is known (NaN: none); what is behind it is left out. ``want``: (queries x
    parts) booleans, the parts in which a query looks for documents.
    """

    scratch: dict = {}  # the last tile's arrays

    def __init__(self, ids, Q, k, metric, squared, exclude_self, digits, last=None, want=None):
        norm = _norms(Q)
        ok = np.isfinite(norm)
        self.ids, self.Q, self.norm = ids, np.where(ok[:, None], Q, 0.0), np.where(ok, norm, 0.0)
        self.k, self.metric, self.digits, self.gap = k, metric, digits, 10.0 ** -digits
        self.root, self.exclude_self, self.want = metric != "cosine" and not squared, exclude_self, want
        self.most, self.sides = self.norm.max(initial=0), {}
        #: What a tile's value may be at most; the k-th key (score, negative cosine) of k answers.
        self.limit, self.kth = np.where(ok, np.inf, -np.inf), np.full(len(ids), np.inf)
        if last is not None:
            known = ok & ~np.isnan(last)
            self.limit[known] = self.within(-last[known] if metric == "cosine" else last[known], self.gap)
        #: Answers so far in the order they came, ``count`` a query; more than k until they are cut.
        self.width = k + max(k, 16)
        self.key, self.found, self.count, self.fresh = np.full((len(ids), self.width), np.inf), None, np.zeros(len(ids), np.int64), 0

    def within(self, key, more):
        """The largest squared distance (negative cosine) that can lie ``more`` behind a key."""
        if not self.root:
            return key + more
        return np.where(key + more > 0, np.square(key + more), -np.inf)

    def room(self, name: str, shape: tuple, kind) -> np.ndarray:
        n = shape[0] * shape[1]
        at = (name, kind)
        if at not in self.scratch or len(self.scratch[at]) < n:
            self.scratch[at] = np.empty(n, kind)
        return self.scratch[at][:n].reshape(shape)

    def exact(self, q, d, docs) -> np.ndarray:
        """Keys of (query, document) pairs."""
        x, y = self.Q[q], docs.D[d]
        if self.metric == "cosine":
            num, den = np.einsum("ij,ij->i", x, y), np.sqrt(self.norm[q]) * np.sqrt(docs.norm[d])
            return -np.round(np.divide(num, den, out=np.zeros_like(num), where=den != 0), self.digits)
        x -= y
        score = np.square(x, out=x).sum(1)
        return np.round(np.sqrt(score) if self.root else score, self.digits)

    def meet(self, docs: _Docs) -> None:
        n = len(docs.ids)
        if n == 0 or len(self.ids) == 0:
            return
        kind = np.float32 if max(self.most, docs.most) < _SINGLE else np.float64
        if kind not in self.sides:
            self.sides[kind] = _side(self.Q, self.norm, self.metric, kind, True)
        far = np.matmul(self.sides[kind], docs.side(kind).T, out=self.room("far", (len(self.ids), n), kind))
        now, some = self.limit, np.flatnonzero(np.isposinf(self.limit))
        if len(some) and n > self.k:
            near = far[some]
            if self.exclude_self:
                near[self.ids[some][:, None] == docs.ids[None, :]] = np.inf
            if self.want is not None:
                near[~self.want[some][:, docs.part]] = np.inf
            near.partition(self.k - 1, axis=1)
            kth = near[:, self.k - 1].astype(np.float64)
            kth += 2 * _slack(self.Q.shape[1], kind) * (1.0 if self.metric == "cosine" else self.norm[some] + docs.most)
            now = self.limit.copy()
            now[some] = self.within(np.sqrt(np.maximum(kth, 0)) if self.root else kth, self.gap)
        with np.errstate(over="ignore"):
            now = np.nextafter(now.astype(kind), kind(np.inf))[:, None]
        near = np.less_equal(far, now, out=self.room("near", far.shape, bool))
        near = np.flatnonzero(near.ravel())
        q, d = np.divmod(near, n)
        keep = np.isfinite(far.ravel()[near])
        if self.exclude_self:
            keep &= self.ids[q] != docs.ids[d]
        if self.want is not None:
            keep &= self.want[q, docs.part[d]]
        if not keep.all():
            q, d = q[keep], d[keep]
        for i in range(0, len(q), _CANDIDATES):
            self.add(q[i:i + _CANDIDATES], d[i:i + _CANDIDATES], docs)
        if len(some) or 2 * self.fresh >= len(self.ids) * self.k:
            self.cut()

    def add(self, q, d, docs: _Docs) -> None:
        """Pairs in the order of queries and documents become answers."""
        key = self.exact(q, d, docs)
        while True:
            keep = key < self.kth[q]  # behind k answers only a better key still counts
            q, d, key = q[keep], d[keep], key[keep]
            if not len(q):
                return
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            at = self.count[q] + np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
            fits = at < self.width
            if self.found is None:
                self.found = np.zeros(self.key.shape, docs.ids.dtype)
            self.key[q[fits], at[fits]], self.found[q[fits], at[fits]] = key[fits], docs.ids[d[fits]]
            self.count += np.bincount(q[fits], minlength=len(self.ids))
            self.fresh += int(fits.sum())
            if fits.all():
                return
            q, d, key = q[~fits], d[~fits], key[~fits]
            self.cut()

    def cut(self) -> None:
        """Leaves the k best of every query; of equal keys those that came first."""
        k, m = self.k, int(self.count.max(initial=0))
        self.fresh = 0
        if m < k:
            return
        key, found = self.key[:, :m], self.found[:, :m]
        kth = np.partition(key, k - 1, axis=1)[:, k - 1]  # infinite where fewer are found
        if m > k:
            keep = key <= kth[:, None]
            if (keep.sum(1) > k).any():
                better, tie = key < kth[:, None], key == kth[:, None]
                keep = better | (tie & (tie.cumsum(1) <= (k - better.sum(1))[:, None]))
            self.key[:, :k], self.found[:, :k] = key[keep].reshape(-1, k), found[keep].reshape(-1, k)
            self.key[:, k:m] = np.inf
            self.count = np.minimum(self.count, k)
        self.kth = kth
        full = np.isfinite(kth)
        self.limit[full] = np.minimum(self.limit[full], self.within(kth[full], -self.gap / 2))

    def answers(self) -> tuple:
        """Query ids, doc ids, scores: a query's answers by (score, doc_id)."""
        self.cut()
        m = int(self.count.max(initial=0))
        key = self.key[:, :m]
        order = np.argsort(key, axis=1, kind="stable")
        full = np.arange(m) < self.count[:, None]
        key = np.take_along_axis(key, order, 1)[full]
        found = np.zeros(0, np.int64) if self.found is None else np.take_along_axis(self.found[:, :m], order, 1)[full]
        return np.repeat(self.ids, self.count), found, -key if self.metric == "cosine" else key


def _block_top_k(qids, Q, dids, D, k, metric, squared, exclude_self, digits, last=None, wants=None, part=None):
    """Top-k (by rounded score, then doc_id) of one query block x doc block.

    ``last``: as for :class:`_Tile`. ``wants`` and ``part``: the query's wanted parts as bits of a whole number, and the
    part (0 to 62) each document lies in.
    """
    out = []
    if len(dids) == 0 or len(qids) == 0:
        return out
    order, rows = np.argsort(_order(dids), kind="stable"), np.arange(len(qids))
    docs = _Docs(dids[order], D[order], metric, None if part is None else part[order])
    if wants is not None:
        rows = np.argsort(wants, kind="stable")
    for s in range(0, len(rows), TILE_ROWS):
        r = rows[s:s + TILE_ROWS]
        want = None if wants is None else (wants[r][:, None] >> np.arange(63)) & 1 == 1
        tile = _Tile(qids[r], Q[r], k, metric, squared, exclude_self, digits, None if last is None else last[r], want)
        for some in docs.tiles(None if want is None else np.flatnonzero(want.any(0)[docs.part])):
            tile.meet(some)
        out.append(tile.answers())
    return out


def _first_k(q_ids, d_ids, score, key, k) -> tuple:
    """The first k rows of each query in (key, doc_id) order: query ids, doc ids, scores."""
    q = _order(q_ids)
    order = np.lexsort((_order(d_ids), key, q))
    q_s = q[order]
    starts = np.r_[0, np.nonzero(np.diff(q_s))[0] + 1]
    pos = np.arange(len(q_s)) - np.repeat(starts, np.diff(np.r_[starts, len(q_s)]))
    keep = order[pos < k]
    return q_ids[keep], d_ids[keep], score[keep]


def merged(parts: list[tuple], k: int, metric: str) -> tuple:
    """One top-k per query from several lists."""
    q, d, score = (np.concatenate(c) for c in zip(*parts))
    return _first_k(q, d, score, -score if metric == "cosine" else score, k)


def _broadcast_search(queries, docs, k, metric, squared, exclude_self, digits, dim):
    spark = docs.sparkSession
    tbl = queries.select("query_id", "embedding").toArrow()
    qids = _ids(tbl.column("query_id").combine_chunks())
    Q = _arrow_matrix(tbl.column("embedding").combine_chunks(), dim)
    bq = spark.sparkContext.broadcast((qids, Q))
    ddl = answer_ddl(queries, docs)
    target = _arrow_schema(ddl)

    def run(batches):
        qids_, Q_ = bq.value
        best = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            D = _arrow_matrix(batch.column("embedding"), Q_.shape[1] if len(Q_) else dim)
            parts = _block_top_k(qids_, Q_, _ids(batch.column("doc_id")), D, k, metric, squared, exclude_self, digits)
            if parts:
                best = merged([*([best] if best else []), *parts], k, metric)
        if best is not None:
            yield answer_batch([best], target)

    return docs.select("doc_id", "embedding").mapInArrow(run, ddl)


def search_blocks(q: DataFrame, d: DataFrame, by: list[str], ddl: str, k, metric, squared, exclude_self, digits, dim=None) -> DataFrame:
    """The top-k lists of every group of ``by``: one task searches a block of vectors for a block of queries.

    Columns ``last`` and ``wants`` of the queries and ``part`` of the documents are those of :func:`_block_top_k`.
    """
    target = _arrow_schema(ddl)

    def column(t: pa.Table, name: str):
        return t[name].to_numpy() if name in t.column_names else None

    def cell(qt: pa.Table, dt: pa.Table) -> pa.Table:
        Q = _arrow_matrix(qt["embedding"].combine_chunks(), dim)
        D = _arrow_matrix(dt["embedding"].combine_chunks(), Q.shape[1] if len(Q) else dim)
        parts = _block_top_k(_ids(qt["query_id"].combine_chunks()), Q, _ids(dt["doc_id"].combine_chunks()), D,
                             k, metric, squared, exclude_self, digits, *(column(*x) for x in ((qt, "last"), (qt, "wants"), (dt, "part"))))
        return pa.Table.from_batches([answer_batch(parts, target)])

    return q.groupBy(*by).cogroup(d.groupBy(*by)).applyInArrow(cell, ddl)


def _grid_search(queries, docs, k, metric, squared, exclude_self, digits, dim, query_block, doc_block, min_blocks):
    n_q = queries.count()
    n_d = docs.count()
    ndb = max(min_blocks, -(-n_d // doc_block))
    # smaller blocks while they would leave cores idle
    idle = min(-(-2 * docs.sparkSession.sparkContext.defaultParallelism // ndb), -(-n_q // TILE_ROWS))
    nqb = max(min_blocks, -(-n_q // query_block), idle)
    q = (queries.select("query_id", "embedding",
                        F.pmod(F.xxhash64("query_id", "embedding"), F.lit(nqb)).cast("int").alias("qb"))
         .withColumn("db", F.explode(F.sequence(F.lit(0), F.lit(ndb - 1)))))
    # both sides' keys are of one type: others hash to other partitions
    d = (docs.select("doc_id", "embedding", F.pmod(F.xxhash64("doc_id", "embedding"), F.lit(ndb)).cast("int").alias("db"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nqb - 1)))))
    return search_blocks(q, d, ["qb", "db"], answer_ddl(queries, docs), k, metric, squared, exclude_self, digits, dim)


def _stream_blocks(n_q: int, n_d: int, k: int, cores: int, doc_block: int) -> tuple[int, int]:
    """Blocks of queries, as many for each core where they are large enough; blocks of documents, for cores left idle."""
    least = -(-n_q // max(1, min(STREAM_QUERIES, STREAM_ANSWERS // k)))
    n = max(1, least, min(-(-least // cores) * cores, -(-n_q // STREAM_LEAST)))
    return n, max(1, min(-(-cores // n), -(-n_d // doc_block)))


def _doc_tiles(batches, dim: int | None, metric: str):
    """Tiles of the documents of Arrow batches, some tiles' rows made ready at once."""
    held, n, most = [], 0, 4 * TILE_COLS

    def tiles():
        t = pa.Table.from_batches(held).select(["doc_id", "embedding"]).combine_chunks()
        for i in range(0, len(t), most):
            some = t.slice(i, most).combine_chunks()
            D = _arrow_matrix(some["embedding"].combine_chunks(), dim)
            yield from _Docs(_ids(some["doc_id"].combine_chunks()), D, metric).tiles()

    for b in batches:
        held, n = [*held, b], n + b.num_rows
        if n >= most:
            yield from tiles()
            held, n = [], 0
    if n:
        yield from tiles()


def _lists(tiles: list[_Tile], k: int, metric: str):
    """(query ids, doc ids, scores, ranks) of tiles whose queries come by rising id; queries of one id have one list."""
    held = None
    for i, tile in enumerate(tiles):
        q, d, score = tile.answers()
        if held is not None or (tile.ids[1:] == tile.ids[:-1]).any():
            q, d, score = merged([*([held] if held else []), (q, d, score)], k, metric)
        held, last = None, q == tile.ids[-1]
        if i + 1 < len(tiles) and tiles[i + 1].ids[0] == tile.ids[-1] and last.any():
            held, (q, d, score) = (q[last], d[last], score[last]), (q[~last], d[~last], score[~last])
        tiles[i] = None
        if len(q):
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            yield q, d, score, (np.arange(1, len(q) + 1) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))).astype(np.int32)


def _stream_search(queries, docs, k, metric, squared, exclude_self, digits, dim, nqb, ndb) -> DataFrame:
    """query_id, doc_id, score, rnk: the top-k lists of every pair of blocks, whose documents pass its queries by rising id."""
    kinds = [df.select(c).schema[0].dataType for df, c in ((queries, "query_id"), (docs, "doc_id"))]

    def block(n, *cols):
        return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # rows of one query_id meet in one block: its list is whole
    q = queries.select(block(nqb, "query_id").alias("qb"), every(ndb).alias("db"), F.lit(False).alias("is_doc"), "query_id",
                       F.lit(None).cast(kinds[1]).alias("doc_id"), "embedding")
    d = docs.select(every(nqb).alias("qb"), block(ndb, "doc_id", "embedding").alias("db"), F.lit(True).alias("is_doc"),
                    F.lit(None).cast(kinds[0]).alias("query_id"), "doc_id", "embedding")
    both = q.unionByName(d).withColumn("block", F.col("qb") * F.lit(ndb) + F.col("db")).drop("qb", "db")
    # a partition is one pair of blocks; queries have no doc_id and come first
    both = both.repartitionById(nqb * ndb, "block").sortWithinPartitions("doc_id", "is_doc").drop("block")
    ddl = answer_ddl(queries, docs) + ", rnk int"
    target = _arrow_schema(ddl)

    def run(batches):
        heads, rest = [], []
        for b in batches:
            n = b.column("is_doc").false_count
            heads, rest = [*heads, *([b.slice(0, n)] if n else [])], [b.slice(n)] if n < b.num_rows else []
            if rest:
                break
        tiles = []
        if heads:
            t = pa.Table.from_batches(heads)
            qids, Q = _ids(t["query_id"].combine_chunks()), _arrow_matrix(t["embedding"].combine_chunks(), dim)
            order = np.argsort(_order(qids), kind="stable")
            for s in range(0, len(order), TILE_ROWS):
                r = order[s:s + TILE_ROWS]
                tiles.append(_Tile(qids[r], Q[r], k, metric, squared, exclude_self, digits))
            width, heads, t, Q = Q.shape[1], None, None, None
            for some in _doc_tiles(itertools.chain(rest, batches), width, metric):
                for tile in tiles:
                    tile.meet(some)
        for _ in batches:  # documents without queries
            pass
        for part in _lists(tiles, k, metric):
            yield answer_batch([part], target)

    return both.mapInArrow(run, ddl)


def knn_search(queries: DataFrame, docs: DataFrame, k: int = 10, metric: str = "l2",
               squared: bool = True, exclude_self: bool = False, digits: int = 6,
               strategy: str = "auto", dim: int | None = None,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES, query_block: int = GRID_QUERY_BLOCK,
               doc_block: int = GRID_DOC_BLOCK, min_blocks: int = 1) -> DataFrame:
    """Exact top-k per query: query_id, doc_id, score, rnk.

    ``queries``: query_id, embedding; ``docs``: doc_id, embedding.
    metric ``'l2'`` (``squared=True`` gives the squared distance, ascending)
    or ``'cosine'`` (similarity, descending; a zero vector scores 0).
    Vectors of unequal length raise. Ties break by doc_id. A task of ``cells`` and ``grid``
    holds ``query_block`` x ``doc_block`` rows on average; the grid has at least ``min_blocks`` a side.
    """
    require_columns(queries, "query_id", "embedding", what="query vectors")
    require_columns(docs, "doc_id", "embedding", what="document vectors")
    if metric not in ("l2", "cosine"):
        raise ValueError(f"unknown metric {metric!r}")
    if strategy in ("auto", "broadcast"):
        n, size = table_size(queries.select("query_id", "embedding"))
        if strategy == "broadcast" and size > max_broadcast_bytes:
            raise ValueError(f"{size} bytes of query vectors are over the broadcast bound {max_broadcast_bytes}")
        few = size <= max_broadcast_bytes and n * k <= MAX_BROADCAST_ANSWERS
        strategy = "broadcast" if few or strategy == "broadcast" else "grid" if min_blocks > 1 or docs.count() <= doc_block else "stream"
    if strategy == "broadcast":
        part = _broadcast_search(queries, docs, k, metric, squared, exclude_self, digits, dim)
    elif strategy == "grid":
        part = _grid_search(queries, docs, k, metric, squared, exclude_self, digits, dim,
                            query_block, doc_block, min_blocks)
    elif strategy == "stream":
        blocks = _stream_blocks(queries.count(), docs.count(), k, docs.sparkSession.sparkContext.defaultParallelism, doc_block)
        part = _stream_search(queries, docs, k, metric, squared, exclude_self, digits, dim, *blocks)
        if blocks[1] == 1:
            return part
        part = part.drop("rnk")
    elif strategy == "cells":
        from rankfold.operators.vector_store import search_once

        return search_once(queries, docs, k, metric, squared, exclude_self, digits, query_block, doc_block)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return top_k(part, k, descending=(metric == "cosine"))
