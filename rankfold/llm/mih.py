"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, rotated by principal axes and an iteratively
learned rotation, and cut to signs (about ``BITS`` of them). The rotation is fitted
on a bounded sample (``SAMPLE`` vectors of smallest id hash); every vector is
coded and indexed. Vectors are dealt into blocks, queries too; a task indexes one
block of vectors, searches it for one block of queries and returns k rows a query,
which are merged.

In a block of n codes a code is split into m substrings of about log2(n) bits, each
with an index from value to codes, so a value is held by about one code by chance.
Round w probes, in every substring, the values that differ from the query's in w
bits. If two codes differ in at most r bits, then by the pigeonhole principle some
substring differs in at most r // m bits, so after round w every code within
m * (w + 1) - 1 bits has been met; most codes not much farther have, too. The
``near`` nearest codes met are reranked by exact cosine in double precision. A query
is done with a block when codes as far away as the k best found there would have
been met with a probability of ``SURE``. Fewer index entries are read than a scan of
all codes would read (see the tests).

Equal vectors are one index entry with their k + 1 smallest ids (a query needs
no more of them), so a vector held by a third of all rows is one entry.

Null, zero and non-finite vectors, vectors with null components, and null ids
take no part. Vectors of other lengths than the most frequent one take no part
either. Repeated rows (same id and vector) count once. Fewer candidates than k:
all are returned. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rankfold.llm.common import text_rows, written

BITS = 128  # about; substrings are of equal length
SAMPLE = 10_000
NEAR = 320
SURE = 0.95
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 2048
EVERY = 50
K = 5


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vec (doubles) of the vectors that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    x = text_rows(vectors, id_col, vec_col).select(F.col(f"`{id_col}`").alias("id"), v.alias("vec")).where("id is not null and vec is not null")
    bad = F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    x = x.where(~bad & F.exists("vec", lambda e: e != 0))
    sizes = x.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return x.where(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def learn(sample: np.ndarray, bits: int = BITS, rounds: int = 30, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): principal axes, then the rotation that brings the projections nearest to their signs."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    mean = unit.mean(0)
    _, _, axes = np.linalg.svd(unit - mean, full_matrices=False)
    rng = np.random.default_rng(seed)
    out, left = [], bits
    while left > 0:  # more bits than dimensions: further rotations of the same axes
        w = axes[: min(left, len(axes))].T
        p = (unit - mean) @ w
        r = np.linalg.qr(rng.normal(size=(w.shape[1], w.shape[1])))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.sign(p @ r).T @ p)
            r = (u @ vt).T
        out.append(w @ r)
        left -= w.shape[1]
    return mean, np.hstack(out)


def layout(n: int, bits: int = BITS) -> tuple[int, int]:
    """(length of a substring, number of substrings) for a block of n codes."""
    length = max(4, min(16, int(math.log2(max(n, 2)))))
    return length, max(1, round(bits / length))


def encode(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray], length: int = 8) -> np.ndarray:
    """Codes as whole numbers, one a substring."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    bits = (unit - model[0]) @ model[1] > 0
    return (bits.reshape(len(bits), -1, length) @ (1 << np.arange(length))).astype(np.uint16)


@lru_cache(maxsize=None)
def reach(w: int, length: int, m: int, sure: float = SURE) -> int:
    """The largest number of differing bits at which a code is met by round w with that probability."""
    for h in range(length * m, -1, -1):
        q = h / (length * m)
        one = sum(math.comb(length, i) * q ** i * (1 - q) ** (length - i) for i in range(w + 1))
        if 1 - (1 - one) ** m >= sure:
            return h
    return 0


POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


@lru_cache(maxsize=None)
def ring(length: int, w: int) -> np.ndarray:
    """All substring differences of w bits."""
    return np.flatnonzero(POPCOUNT[: 1 << length] == w)


class MultiIndex:
    """One index per substring over a block of codes."""

    def __init__(self, codes: np.ndarray, length: int = 8):
        self.codes, self.length = codes, length
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.starts = [np.searchsorted(np.sort(codes[:, j]), np.arange((1 << length) + 1)) for j in range(codes.shape[1])]
        self.read = 0  # index entries read so far

    def probe(self, code: np.ndarray, w: int, distance: np.ndarray) -> np.ndarray:
        """Fills in the distances (-1: not met) of the codes some substring of which differs in w bits; returns the new ones."""
        found = []
        for j in range(self.codes.shape[1]):
            values = int(code[j]) ^ ring(self.length, w)
            lo = self.starts[j][values]
            size = self.starts[j][values + 1] - lo
            stop = np.cumsum(size)
            self.read += int(stop[-1])
            rows = self.order[np.repeat(lo - stop + size, size) + np.arange(stop[-1]), j]
            rows = rows[distance[rows] < 0]
            distance[rows] = POPCOUNT[self.codes[rows] ^ code].sum(1, dtype=np.int16)
            found.append(rows)
        return np.concatenate(found)

    def within(self, code: np.ndarray, near: int) -> np.ndarray:
        """Rows of every code within the smallest probed radius that holds ``near`` codes (all rows, if fewer)."""
        n, m = self.codes.shape
        distance = np.full(n, -1, np.int16)
        for w in range(self.length + 1):  # after weight w in all substrings, radius m * (w + 1) - 1 is complete
            self.probe(code, w, distance)
            radius = min(m * (w + 1) - 1, self.length * m)
            inside = distance[(distance >= 0) & (distance <= radius)]
            if len(inside) >= min(near, n):
                # the smallest radius inside the complete one that holds enough
                sizes = np.cumsum(np.bincount(inside, minlength=radius + 1))
                return np.flatnonzero((distance >= 0) & (distance <= int(np.searchsorted(sizes, min(near, n)))))
        return np.arange(n)

    def rounds(self, code: np.ndarray, near: int):
        """After each round: (round, rows of the ``near`` nearest codes met and all that tie with the last, their distances)."""
        distance = np.full(len(self.codes), -1, np.int16)
        met = np.zeros(0, np.int64)
        for w in range(self.length + 1):
            met = np.concatenate([met, self.probe(code, w, distance)])
            d = distance[met]
            if len(met) > near:
                cut = np.partition(d, near - 1)[near - 1]
                yield w, met[d <= cut], d[d <= cut]
            else:
                yield w, met, d


def search_block(ids: list[list[int]], vectors: np.ndarray, query_ids, queries: np.ndarray, model, k: int, near: int, length: int = 8,
                 sure: float = SURE, index: MultiIndex | None = None):
    """The k nearest of a block for each query: (query_id, vec_id, score), ties to the smaller id."""
    index = index or MultiIndex(encode(vectors, model, length), length)
    m = index.codes.shape[1]
    norms = np.linalg.norm(vectors, axis=1)
    out = []
    for q, vec, code in zip(query_ids, queries, encode(queries, model, length)):
        size = np.linalg.norm(vec)
        for w, rows, distance in index.rounds(code, near):
            last = w == length
            if len(rows) <= k and not last:
                continue
            cosine = (vectors[rows] * vec).sum(1) / (norms[rows] * size)
            # the query's own entry may be among them, so k + 1 entries, and all that tie with the last
            edge = np.partition(cosine, -(k + 1))[-(k + 1)] if len(rows) > k + 1 else -np.inf
            best = cosine >= edge
            if last or distance[best].mean() <= reach(w, length, m, sure):
                break
        found = [(-float(c), i) for c, r in zip(cosine[best], rows[best]) for i in ids[r] if i != q]
        out += [(q, i, -c) for c, i in sorted(found)[:k]]
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int = K, near: int = NEAR, bits: int = BITS, block_vectors: int = BLOCK_VECTORS,
           block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs are (id, vec) as ``usable`` gives them."""
    spark = vectors.sparkSession
    entries = written(vectors.distinct().groupBy("vec").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")), "mih-entries")
    # the k + 1 smallest ids of equal vectors
    shared = vectors.join(entries.where("n > 1").select("vec"), "vec")
    shared = shared.distinct().withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= k + 1)
    shared = shared.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("more"))
    entries = written(entries.join(shared, "vec", "left").select("vec", F.coalesce("more", F.array("id")).alias("ids"), F.col("id").alias("first")), "mih-index")
    asked = written(queries.distinct().select(F.col("id").alias("query_id"), F.col("vec").alias("query")), "mih-queries")
    n, nq = entries.count(), asked.count()
    if not n or not nq:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.orderBy(F.xxhash64("first"), "first").limit(SAMPLE).select("vec").toArrow()
    length, m = layout(min(n, block_vectors), bits)
    model = learn(np.array(sample["vec"].to_pylist()), length * m)
    nb, qb = -(-n // block_vectors), -(-nq // block_queries)
    cells = lambda x, key, own, own_n, other, other_n: x.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_n)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1))))
    left = cells(entries, "first", "vb", nb, "qb", qb)
    right = cells(asked, "query_id", "qb", qb, "vb", nb)
    kind = vectors.schema["id"].dataType.simpleString()
    target = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = []
        if a.num_rows and b.num_rows:
            matrix = lambda t, c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
            rows = search_block(a["ids"].to_pylist(), matrix(a, "vec"), b["query_id"].to_pylist(), matrix(b, "query"), model, k, near,
                                length)
        return pa.table([[r[i] for r in rows] for i in range(3)], schema=target)

    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(cell, f"query_id {kind}, vec_id {kind}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8(embeddings: DataFrame) -> DataFrame:
    v = written(usable(embeddings, "vec_id", "embedding"), "mih-vectors")
    return search(v, v.where(F.col("id") % EVERY == 0))
