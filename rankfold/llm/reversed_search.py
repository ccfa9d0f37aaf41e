"""Ranked lexical search, reversed: the documents stream past an inverted index over the items.

The items' terms make the index: term -> (item, occurrences in the item). It is
broadcast in blocks of bounded size, each block one pass:

1. Every document's whole text is cut into terms once; its term count and the
   counts of the block's terms are written, a sparse row per document. Sums of
   these rows give N, L and each term's document frequency.
2. The rows stream through the index. A document's score for an item is the sum
   over their common terms; each task keeps a heap of the ``k`` best documents
   per item, and only documents that beat an item's worst are pushed.
3. The tasks' heaps, k rows per item and task at most, are merged per item.

Terms, weights and scores are integers after the weight's logarithm, so results
don't depend on the order in which rows arrive. Equal scores: smaller doc_id
first, null last.

Null or empty text: no terms, so the document counts nowhere and the item finds
nothing. Rows with equal item ids: one item, its smallest text. Rows with equal
doc_ids: documents of their own. Null ids: kept as they are. Very long texts are
cut whole. Empty tables: empty result. Further columns are left out, whatever
their names. Document ids are whole numbers.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankfold.llm.common import forget, hand_back, map_batches, slices, written
from rankfold.session import table_size

TOP = 20
#: Items of a block, and bytes of its terms, at most (one item's terms are never split).
BLOCK_ITEMS, BLOCK_BYTES = 8_192, 32 * 1024 * 1024
_CELLS = 2_000_000  # document x item scores held at once
_LAST = 1 << 63  # stands for a null doc_id: after every other

#: What becomes of each byte of UTF-8: letters lower-cased in ASCII only, digits and bytes beyond ASCII kept, others part terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_FOLD).split() if text else []


def _texts(column: pa.Array) -> list[bytes | None]:
    return pc.cast(column, pa.large_binary()).to_pylist()


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, term, qtf: the terms of each item (written)."""
    one = items.groupBy(F.col(f"`{id_col}`").alias("item")).agg(F.min(F.col(f"`{text_col}`")).alias("text"))

    def cut(_, cols):
        out = {"item": [], "term": [], "qtf": []}
        for item, text in zip(cols["item"], cols["text"]):
            counts: dict[bytes, int] = {}
            for t in terms(text.encode() if text else None):
                counts[t] = counts.get(t, 0) + 1
            for t, c in counts.items():
                out["item"].append(item)
                out["term"].append(t.decode())
                out["qtf"].append(c)
        return out

    kind = one.schema["item"].dataType.simpleString()
    return written(map_batches(one, cut, f"item {kind}, term string, qtf long"), "reversed-terms")


class Index:
    """The inverted index over one block of items, as arrays: postings of term i at ptr[i]:ptr[i + 1]."""

    def __init__(self, rows: list[tuple]):
        self.items = list(dict.fromkeys(r[0] for r in rows))
        number = {item: i for i, item in enumerate(self.items)}
        self.vocabulary = {t: i for i, t in enumerate(dict.fromkeys(r[1] for r in rows))}
        term = np.array([self.vocabulary[r[1]] for r in rows], np.int64)
        order = np.argsort(term, kind="stable")
        self.item = np.array([number[r[0]] for r in rows], np.int64)[order]
        self.qtf = np.array([r[2] for r in rows], np.int64)[order]
        self.ptr = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))

    def scores(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Documents x items: the sums of ``value`` (per document and term) times the items' counts."""
        size = self.ptr[term + 1] - self.ptr[term]
        row = np.repeat(np.arange(len(term)), size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + self.ptr[term][row]
        out = np.zeros(n_docs * len(self.items), np.int64)
        np.add.at(out, doc[row] * len(self.items) + self.item[at], value[row] * self.qtf[at])
        return out.reshape(n_docs, len(self.items))


def document_counts(docs: DataFrame, vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n, terms, tfs per document with a term: ``vocabulary`` (a broadcast dict) numbers the terms that are counted."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32()))])

    def run(batches):
        forget()
        number = {t.encode(): i for t, i in vocabulary.value.items()}
        for batch in (part for whole in batches for part in slices(whole)):
            out: list[list] = [[], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                words = terms(text)
                if not words:
                    continue
                hit, count = np.unique(np.array([i for i in map(number.get, words) if i is not None], np.int32), return_counts=True)
                for col, value in zip(out, (doc, len(words), hit, count.astype(np.int32))):
                    col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
        hand_back()

    cols = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return cols.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<int>")


def weights(df: dict[int, int], n_terms: int, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(n_terms)], np.int64)


def _search_block(counts: DataFrame, index, weight: np.ndarray, n_docs: int, total: int, k: int, kind: str) -> DataFrame:
    """item, doc, score: each task's heaps."""
    ddl = f"item {kind}, doc long, score long"
    target = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        forget()
        ix = index.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in ix.items]
        floor = np.zeros(len(ix.items), np.int64)  # an item's worst score that still counts
        step = max(1, _CELLS // max(1, len(ix.items)))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids = batch.column(0).to_pylist()
                length = 75 + 25 * batch.column(1).to_numpy() * n_docs // total
                size = pc.list_value_length(batch.column(2)).to_numpy()
                term = batch.column(2).flatten().to_numpy().astype(np.int64)
                tf = batch.column(3).flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(len(ids)), size)
                value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length[doc]))
                score = ix.scores(doc, term, value, len(ids))
                for d, i in zip(*np.nonzero((score > 0) & (score >= floor))):
                    heap, entry = heaps[i], (int(score[d, i]), -(_LAST if ids[d] is None else ids[d]))
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    if len(heap) == k:
                        floor[i] = heap[0][0]
        out = [(ix.items[i], None if -d == _LAST else -d, s) for i, heap in enumerate(heaps) for s, d in heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
        hand_back()

    return counts.mapInArrow(run, ddl)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id",
           text_col: str = "text", block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item, rank, doc, score: the ``k`` best documents of each item, scores above 0 only."""
    spark = docs.sparkSession
    postings = item_terms(items, item_col, item_text)
    kind = postings.schema["item"].dataType.simpleString()
    n_items = postings.select("item").distinct().count()
    blocks = max(1, -(-n_items // block_items), -(-table_size(postings)[1] // block_bytes))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = spark.createDataFrame([], f"item {kind}, doc long, score long")
    for b in range(blocks):
        index = Index([tuple(r) for r in postings.where(block == b).toLocalIterator()])
        if not index.items:
            continue
        counts = written(document_counts(docs, spark.sparkContext.broadcast(index.vocabulary), id_col, text_col), "reversed-counts")
        n_docs, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = {r[0]: r[1] for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # the block's terms
        weight = weights(df, len(index.vocabulary), n_docs)
        part = _search_block(counts, spark.sparkContext.broadcast(index), weight, n_docs, total, k, kind)
        found = found.unionByName(part)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item", "rank", "doc", "score")


def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    return search(docs, items).select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
n AS (SELECT rid, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM n),
i AS (SELECT item_id, {_TERMS} AS t FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)),
q AS (SELECT item_id, term, count(*)::BIGINT AS qtf FROM (SELECT item_id, unnest(t) AS term FROM i) GROUP BY item_id, term),
v AS (SELECT DISTINCT term FROM q),
tf AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(t) AS term FROM d) SEMI JOIN v USING (term) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), c),
m AS (SELECT rid, doc_id, 75 + (25 * n * n_docs) // total AS m FROM n, c),
s AS (SELECT item_id, rid, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY item_id, rid, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
