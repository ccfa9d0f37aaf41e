"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Random indexing: every term has a fixed sparse ternary index vector (drawn from
its hash); a term's word vector is its index vector plus the sum of the index
vectors found around it in the training texts, each at unit length. Terms are
words and their shapes (letters, digits and marks, runs squeezed); a word seen
too seldom for a vector of its own has its shape's. A document is the mean of
its word vectors, with the share of its word pairs already seen in it and its
log length. The network has one hidden layer; its logit is divided by a
temperature fitted on labelled rows kept out of its training.

It is fitted on a bounded sample: the ``train_rows`` labelled rows (of those
that may be learned from) with the smallest id hash, whole texts. Everything
else covers all documents.

Null and empty texts score like any other (no words: the zero vector). Repeated
rows give repeated rows. A null doc_id is scored and counts as not held out.
Several labels of one document count as their mean, rounded up. Without labels
of both kinds the score is the share of label 1 (1 if there are none).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankfold.llm.common import counter_hash, forget, map_batches, text_rows, written

DIM = 64
NONZERO = 6
WINDOW = 2
TRAIN_ROWS = 6000
VOCABULARY = 12_000
MIN_DOCS = 8
HIDDEN = 32
CUT = 0.7
MEMO_WORDS = 100_000


_RUNS = re.compile(rb"([a-z\x80-\xff])[a-z\x80-\xff]*|([A-Z])[A-Z]*|([0-9])[0-9]*|([^a-zA-Z0-9\x80-\xff])\4*")


def shape(word: bytes) -> bytes:
    """Small letters (and all beyond ASCII) as x, capitals X, digits 9, marks as they are; runs squeezed to one."""
    return _RUNS.sub(lambda m: b"x" if m[1] else b"X" if m[2] else b"9" if m[3] else m[4], word)


def index_vector(term: bytes) -> np.ndarray:
    import xxhash

    h = counter_hash(np.full(NONZERO, xxhash.xxh3_64_intdigest(term), np.uint64), np.arange(NONZERO))
    v = np.zeros(DIM, np.float32)
    np.add.at(v, (h % np.uint64(DIM)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0))
    return v


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def seen_pairs(words: list[bytes]) -> float:
    """The share of word pairs that stand earlier in the text, too."""
    n = len(words)
    if n < 2:
        return 0.0
    first: dict = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    return 1 - len(np.unique(ids[:-1] * n + ids[1:])) / (n - 1)


class Vectors:
    """Rows of word vectors: one a known word or shape, the last for unknown shapes."""

    def __init__(self, words: dict[bytes, int], shapes: dict[bytes, int], table: np.ndarray):
        self.words, self.shapes, self.table = words, shapes, table

    def start(self) -> None:
        vectors, unknown = self, len(self.table) - 1

        class Rows(dict):
            def __missing__(self, word):
                if len(self) > MEMO_WORDS:
                    self.clear()
                row = vectors.words.get(word)
                self[word] = row = vectors.shapes.get(shape(word), unknown) if row is None else row
                return row

        self.rows = Rows()

    def pooled(self, text: str | None) -> np.ndarray:
        words = split(text)
        out = np.zeros(DIM + 2, np.float32)
        if words:
            at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
            if len(at) > 2 * len(self.table):
                out[:DIM] = np.bincount(at, minlength=len(self.table)) @ self.table / len(at)
            else:
                out[:DIM] = self.table[at].mean(0)
            out[DIM] = seen_pairs(words)
            out[DIM + 1] = np.log1p(len(words))
        return out


def fit_vectors(train: DataFrame, text_col: str) -> Vectors:
    """Word vectors from the (bounded) training texts: term counts, then context sums of the kept terms."""

    def count(_, cols):
        got: dict[bytes, int] = {}
        for t in cols[text_col]:
            words = set(split(t))
            for term in {b"w" + w for w in words} | {b"s" + shape(w) for w in words}:
                got[term] = got.get(term, 0) + 1
        return {"term": list(got), "n": list(got.values())}

    terms = map_batches(train.select(text_col), count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = [bytes(r["term"]) for r in terms.where(F.col("n") >= MIN_DOCS).orderBy(F.desc("n"), "term").limit(VOCABULARY).collect()]
    at = {t: i for i, t in enumerate(kept)}

    def around(_, cols):
        total = np.zeros((len(at) + 1, DIM), np.float32)
        memo: dict[bytes, tuple] = {}
        for t in cols[text_col]:
            words = split(t)
            if len(memo) > 30_000:
                memo.clear()
            for w in words:
                if w not in memo:
                    memo[w] = (index_vector(b"w" + w), at.get(b"w" + w, len(at)), at.get(b"s" + shape(w), len(at)))
            if not words:
                continue
            own = np.array([memo[w][0] for w in words])
            near = np.zeros_like(own)
            for d in range(1, WINDOW + 1):
                near[d:] += own[:-d] if d < len(own) else 0
                near[:-d] += own[d:] if d < len(own) else 0
            np.add.at(total, [memo[w][1] for w in words], near)
            np.add.at(total, [memo[w][2] for w in words], near)
        return {"sums": [total.tobytes()]}

    # a few tasks, each returning one matrix of at most VOCABULARY rows
    parts = map_batches(train.select(text_col).coalesce(4), around, "sums binary").collect()
    context = sum((np.frombuffer(r["sums"], np.float32).reshape(-1, DIM) for r in parts), np.zeros((len(at) + 1, DIM), np.float32))
    own = np.array([index_vector(t) for t in kept] or np.zeros((0, DIM)), np.float32).reshape(-1, DIM)
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    table = np.vstack([unit(own) + unit(context[:-1]), np.zeros((1, DIM), np.float32)])
    words = {t[1:]: i for t, i in at.items() if t[:1] == b"w"}
    shapes = {t[1:]: i for t, i in at.items() if t[:1] == b"s"}
    both = table.copy()  # a known word also carries its shape
    for w, i in words.items():
        both[i] += table[shapes.get(shape(w), len(kept))]
    return Vectors(words, shapes, both)


class Network:
    """Two layers in numpy, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3, epochs: int = 60):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = (x - self.mean) / self.scale
        order = rng.permutation(len(z))
        cut = max(1, len(z) // 5)
        held, learn = order[:cut], order[cut:]
        if len(set(y[learn])) < 2 or len(set(y[held])) < 2:
            held = learn = order
        self.w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        m, v, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 128)):
                a = np.tanh(z[rows] @ self.w[0] + self.w[1])
                p = 1 / (1 + np.exp(-np.clip(a @ self.w[2] + self.w[3], -40, 40)))
                d = (p - y[rows]) / len(rows)
                back = np.outer(d, self.w[2]) * (1 - a * a)
                grads = [z[rows].T @ back + 1e-4 * self.w[0], back.sum(0), a.T @ d + 1e-4 * self.w[2], np.array([d.sum()])]
                step += 1
                for i, g in enumerate(grads):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.w[i] -= 0.005 * m[i] / (1 - 0.9 ** step) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        logit = self.logits(x[held])
        loss = lambda t: np.logaddexp(0, np.where(y[held] == 1, -logit, logit) / t).mean()
        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, text_col: str = "text", label_col: str = "quality"):
    """(vectors, network or None, share of label 1), learned from rows that aren't held out."""
    labelled = text_rows(labels, "doc_id", label_col).where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & ~held_out())
    labelled = labelled.groupBy("doc_id").agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    chosen = written(labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows), "quality-sample")
    train = text_rows(docs, "doc_id", text_col).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min(text_col).alias(text_col))
    train = written(train.select("doc_id", text_col, "y"), "quality-train")
    counts = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 1.0
    if len(counts) < 2:
        return None, None, share
    vectors = fit_vectors(train, text_col)

    def pool(vec, cols):
        return {"doc_id": cols["doc_id"], "y": cols["y"], "x": [vec.pooled(t).tolist() for t in cols[text_col]]}

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    rows = map_batches(train, pool, f"doc_id {kind}, y int, x array<float>", init=lambda: vectors.start() or vectors).orderBy("doc_id").collect()
    return vectors, Network(np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], np.float64)), share


def score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """doc_id, score of every document."""
    vectors, network, share = model

    def run(state, cols):
        texts = cols[text_col]
        got = network(np.array([state.pooled(t) for t in texts])).tolist() if network else [share] * len(texts)
        return {"doc_id": cols["doc_id"], "score": got}

    kind = docs.select("doc_id").schema[0].dataType.simpleString()
    return map_batches(text_rows(docs, "doc_id", text_col), run, f"doc_id {kind}, score double",
                       init=lambda: vectors and (vectors.start() or vectors))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    x = score(docs, fit(docs, labels))
    return x.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents scoring ``cut`` or more, all columns; only the texts go through Python, and nothing is joined."""
    vectors, network, share = fit(docs, labels)
    if network is None:
        return docs if share >= cut else docs.limit(0)

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        if not hasattr(vectors, "rows"):
            forget()
            vectors.start()
        return pa.array(network(np.array([vectors.pooled(t.as_py()) for t in text])) >= cut)

    return docs.where(good("text"))
