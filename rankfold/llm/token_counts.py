"""Count-only Viterbi: how many tokens a unigram tokenizer makes, without making them.

The Aho-Corasick automaton gives every vocabulary match of a chunk; the
dynamic programme carries the best score and its piece count per position.
Ties follow the tokenizer: a later candidate replaces an earlier one only if
it scores strictly higher, and candidates are met by start position, so the
longest last piece wins. A character without a piece costs one unknown edge and
counts as its UTF-8 bytes.

Null and empty texts have no tokens and score 0. Texts of any length are cut
into chunks exactly (see ``unigram``), so memory does not grow with a text.
Repeated rows give repeated rows; a null id is passed through.
"""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame

from rankfold.llm import unigram
from rankfold.llm.common import map_batches, shared_state, text_rows

#: Chunks remembered per worker; beyond it the memory starts anew.
CACHE_CHUNKS = 600_000


def solve(vocab: unigram.Vocabulary, chunk: str) -> tuple[int, float]:
    """Piece count and score of the best segmentation of a chunk."""
    n = len(chunk)
    best, count = [-1e300] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    for end, length, piece, logp in vocab.edges(chunk):
        start = end - length
        score = best[start] + logp
        if score > best[end]:
            best[end] = score
            count[end] = count[start] + (1 if piece >= 0 else len(chunk[start].encode("utf-8", "surrogatepass")))
    return count[n], best[n]


class Counter:
    """Counts whole texts; remembers the chunks it has solved."""

    def __init__(self, path: str, cache_chunks: int = CACHE_CHUNKS):
        self.vocab = unigram.vocabulary(path)
        self.cache_chunks = cache_chunks
        self.reset()

    def reset(self) -> None:
        counter = self

        class Memo(dict):
            def __missing__(self, chunk):
                c, s = solve(counter.vocab, chunk)
                counter.counts.append(c)
                counter.scores.append(s)
                self[chunk] = i = len(counter.counts) - 1
                return i

        self.memo, self.counts, self.scores = Memo(), array("q"), array("d")

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if len(self.memo) > self.cache_chunks:
            self.reset()
        chunks = self.vocab.chunks(text)
        at = np.fromiter(map(self.memo.__getitem__, chunks), np.int64, len(chunks))
        return (int(np.frombuffer(self.counts, np.int64)[at].sum()),
                float(np.frombuffer(self.scores, np.float64)[at].sum()))


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, n_tokens and the best score of every whole text."""
    path = path or unigram.default_path()
    ids = docs.select(id_col).schema[0].dataType.simpleString()

    def run(counter, cols):
        got = [counter(t) for t in cols[text_col]]
        return {id_col: cols[id_col], "n_chars": [len(t or "") for t in cols[text_col]],
                "n_tokens": [c for c, _ in got], "score": [s for _, s in got]}

    return map_batches(text_rows(docs, id_col, text_col), run,
                       f"`{id_col}` {ids}, n_chars long, n_tokens long, score double", init=lambda: shared_state(("counter", path), lambda: Counter(path)))
