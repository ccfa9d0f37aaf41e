"""A unigram vocabulary over public SentencePiece pieces, with Aho-Corasick matching.

The pieces come from a public ``.model`` file (its path is a parameter). Their
log probabilities follow Zipf's law on the piece's rank, rounded to multiples
of 1/64, so that sums are exact in double precision and ties are real ties.
Nothing is trained.

Text is written as SentencePiece does: a space in front (not for the empty
text), every space as U+2581 (a U+2581 in the text counts as a space), and
characters without a piece as the pieces of their UTF-8 bytes.

No piece crosses the border between letters and other characters, nor holds a
space mark after another character (checked on load). A text may therefore be
cut at these borders into chunks that are solved on their own, and a chunk met
before is looked up.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # the tokenizer's penalty below the lowest score


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(self.size)]
        self.byte_ids = [i for i in range(self.size) if sp.is_byte(i)]
        special = {i for i in range(self.size) if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)}
        self.normal = [i for i in range(self.size) if i not in special]
        first = self.normal[0]
        self.logp = [0.0] * self.size
        for i in self.normal:
            self.logp[i] = -round(64 * math.log(i - first + 2)) / 64
        self.unknown = min(self.logp[i] for i in self.normal) - UNKNOWN_PENALTY
        for i in self.byte_ids:
            self.logp[i] = self.unknown
        self.ids = {self.pieces[i]: i for i in self.normal}
        self.single = {p for p in self.ids if len(p) == 1}
        self.longest = max(map(len, self.ids))
        self.lengths = [len(p) for p in self.pieces]
        self.matcher = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.matcher.add_word(p, i)
        self.matcher.make_automaton()
        self.chunk = self._chunks()
        raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids):
            raw[i] = bytes([b])
        self._raw = pa.array(raw, pa.large_binary())
        self._table = np.frombuffer(b"".join(raw), np.uint8)
        self._sizes = np.array([len(x) for x in raw], np.int64)
        self._places = np.cumsum(self._sizes) - self._sizes

    def _chunks(self) -> re.Pattern:
        letter = re.compile(r"[^\W\d_]")
        other: set[str] = set()
        for p in self.ids:
            body = p.lstrip(MARK)
            if MARK in body:
                raise ValueError(f"piece {p!r} holds a space mark after another character")
            for a, b in zip(body, body[1:]):
                if bool(letter.match(a)) != bool(letter.match(b)):
                    other.add(a if letter.match(a) else b)
        for p in self.ids:
            body = p.lstrip(MARK)
            kinds = {bool(letter.match(c)) and c not in other for c in body}
            if len(kinds) > 1:
                raise ValueError(f"piece {p!r} crosses a chunk border")
        odd = "".join(map(re.escape, sorted(other)))
        return re.compile(rf" *[^\W\d_{odd}]+| *(?:[^\w ]|[\d_{odd}])+| +")

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, spaces not yet marked; joined they are ' ' + text."""
        return self.chunk.findall(" " + text.replace(MARK, " ")) if text else []

    def edges(self, chunk: str):
        """(end, length, id, log probability) of every piece found, by end, longest first.

        A character without a piece of its own gives an edge with id -1, after
        the others with that end: the tokenizer meets it last, too.
        """
        s = chunk.replace(" ", MARK)
        at, lengths, logp = 0, self.lengths, self.logp
        for end, i in self.matcher.iter(s):
            while at < end:
                at += 1
                if s[at - 1] not in self.single:
                    yield at, 1, -1, self.unknown
            yield end + 1, lengths[i], i, logp[i]
        while at < len(s):
            at += 1
            if s[at - 1] not in self.single:
                yield at, 1, -1, self.unknown

    def decode_bytes(self, ids) -> bytes:
        """The UTF-8 bytes of a sequence of ids, the space in front included."""
        ids = np.asarray(ids, np.int64)
        size = self._sizes[ids]
        stop = np.cumsum(size)
        return self._table[np.repeat(self._places[ids] - stop + size, size) + np.arange(stop[-1] if len(ids) else 0)].tobytes()

    def decode_all(self, ids: np.ndarray, stops: np.ndarray) -> tuple[bytes, list[int]]:
        """The UTF-8 bytes of many sequences of ids, one behind the other, and where each sequence's end."""
        got = self._raw.take(pa.array(ids))
        places = np.frombuffer(got.buffers()[1], np.int64)[got.offset: got.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return b"".join(got.buffers()[2:][:len(ids)]), places[stops].tolist()

    def decode(self, ids) -> str:
        """The text of a sequence of ids: marks become spaces, byte pieces bytes, one space in front goes."""
        out = self.decode_bytes(ids).decode("utf-8", "surrogatepass")
        return out[1:] if out.startswith(" ") else out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per worker process."""
    return Vocabulary(path)
