"""Sampled SentencePiece segmentations without replacement, and their decoding.

Perturbed A-star search over the lattice of a whole text: a set of
segmentations carries one Gumbel variable, the largest perturbed log
probability among its members. The set with the largest value is opened: its
best member is drawn edge by edge, and at every step the set "same so far, but
another edge here" gets a Gumbel variable truncated at the opened value and
goes on the agenda. The first k values popped are the Gumbel top-k: k distinct
segmentations drawn without replacement. The (k+1)-th value kappa gives the
inclusion score 1 - exp(-exp(log_prob - kappa)).

The lattice of a text is the product of its chunks' lattices (see ``unigram``).
Chunk lattices (backward edge probabilities from forward sums) are remembered;
drawing runs over all chunks of many documents at once, one backward step per
round. Random numbers come from a counter hash of (seed, row key, sample,
chunk, step), so a result does not depend on partitions, batches or retries.

Null and empty texts have one segmentation, the empty one: one row, no pieces.
A text with fewer than k segmentations gives all of them, with inclusion 1.
Texts of any length are done whole: memory is one text's chunks. Repeated rows
(same key and text) give repeated rows. A null key is a key like any other.
"""

from __future__ import annotations

import math
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from rankfold.llm import unigram
from rankfold.llm.common import counter_hash, map_batches, shared_state, text_rows, to_unit, uniform

#: Lattice nodes remembered per worker (about 50 bytes each), and characters of texts drawn at once.
CACHE_NODES = 4_000_000
BATCH_CHARS = 600_000
#: Steps of a leaf looked at at once for the sets beside it.
WINDOW = 384


def row_key(seed: int, key) -> int:
    """The counter-hash key of a row."""
    text = repr(key).encode()
    return (zlib.crc32(text) << 32 | zlib.crc32(text[::-1], seed & 0xFFFFFFFF)) ^ (seed * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))


class Lattices:
    """Backward edge probabilities of every node of the chunks met so far.

    Edges into a node lie together, from ``first[node]`` (-1 at a chunk's start) to the one whose ``cdf`` is 2. An edge
    comes from node ``prev``; ``lp`` is its log probability given the node it leads into.
    """

    def __init__(self, vocab: unigram.Vocabulary, nodes: int = CACHE_NODES):
        self.vocab, self.room = vocab, nodes
        self.lengths = np.array([len(p) for p in vocab.pieces], np.int64)
        self.lengths[vocab.byte_ids] = 1
        self.lengths[0] = 1  # the unknown edge
        self.logp = np.array(vocab.logp)
        self.logp[0] = vocab.unknown
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(c) for c in vocab.single]] = True
        self.reset()

    def reset(self) -> None:
        few = self.room // 8
        self.first = np.zeros(few, np.int32)
        self.cdf, self.piece = np.zeros(2 * few, np.float32), np.zeros(2 * few, np.uint16)
        self.prev, self.lp = np.zeros(2 * few, np.int32), np.zeros(2 * few)
        self.nodes = self.edges = 0
        self.end: dict[str, int] = {}
        self.unknown: dict[int, bytes] = {}

    def grow(self, nodes: int, edges: int) -> None:
        for names, used, wanted in ((("first",), self.nodes, nodes), (("cdf", "piece", "prev", "lp"), self.edges, edges)):
            for name in names:
                old = getattr(self, name)
                if used + wanted > len(old):
                    new = np.zeros(used + wanted + len(old) // 2, old.dtype)
                    new[:used] = old[:used]
                    setattr(self, name, new)

    def add(self, chunks: list[str]) -> None:
        """One node per character, and one before each chunk; all chunks are solved together, by depth."""
        base, edge0 = self.nodes, self.edges
        text = "\0" + "\0".join(c.replace(" ", unigram.MARK) for c in chunks)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        start = np.cumsum(size + 1) - size - 1
        depth = np.arange(len(text)) - np.repeat(start, size + 1)
        found = np.fromiter(chain.from_iterable(self.vocab.matcher.iter(text)), np.int64)
        end, piece = found[::2], found[1::2]
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        odd = np.flatnonzero(~self.known[code] & (depth > 0))
        plain = code[odd] < 128
        for i in odd[~plain]:
            self.unknown[base + int(i)] = text[i].encode("utf-8", "surrogatepass")
        byte = np.where(plain, np.array(self.vocab.byte_ids)[np.minimum(code[odd], 127)], 0)
        end, piece = np.concatenate([end, odd]), np.concatenate([piece, byte])
        order = np.lexsort((end, depth[end]))
        end, piece = end[order], piece[order]
        score = self.logp[piece]
        before = end - self.lengths[piece]
        first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
        stops = np.append(first, len(end))
        levels = np.flatnonzero(np.concatenate([[True], np.diff(depth[end[first]]) > 0, [True]]))
        alpha = np.zeros(len(text))
        for a, b in zip(levels[:-1], levels[1:]):
            lo, hi = stops[a], stops[b]
            alpha[end[first[a:b]]] = np.logaddexp.reduceat(alpha[before[lo:hi]] + score[lo:hi], first[a:b] - lo)
        lp = alpha[before] + score - alpha[end]
        p = np.exp(lp)
        total = np.cumsum(p)
        cdf = total - np.repeat((total - p)[first], np.diff(stops))
        cdf[stops[1:] - 1] = 2.0
        self.grow(len(text), len(end))
        self.first[base + start] = -1
        self.first[base + end[first]] = edge0 + first
        for store, x in ((self.cdf, cdf), (self.piece, piece), (self.prev, base + before), (self.lp, lp)):
            store[edge0: edge0 + len(end)] = x
        self.nodes, self.edges = base + len(text), edge0 + len(end)
        self.end.update(zip(chunks, (base + start + size).tolist()))

    def ends(self, chunks: list[str]) -> np.ndarray:
        """The end node of every chunk."""
        new = list(set(chunks).difference(self.end))
        for i in range(0, len(new), 20_000):
            self.add(new[i: i + 20_000])
        return np.fromiter(map(self.end.__getitem__, chunks), np.int64, len(chunks))

    def into(self, node: int) -> np.ndarray:
        """The edges into a node."""
        a = int(self.first[node])
        return np.arange(a, a + 1 + int((self.cdf[a: a + self.vocab.longest + 2] > 1.5).argmax()))


class Leaf:
    """A drawn segmentation, as steps: the ``head`` of an earlier leaf, left at its last step ``t0``, and what was drawn
    behind it, edges ``a`` to ``b`` of its round. ``banned`` edges of the step ``t0`` belong to sets opened before."""

    __slots__ = ("edges", "lp", "chunks", "t0", "banned", "rest", "a", "b", "same")

    def __init__(self, edges, lp, chunks, banned=(), rest=0.0):
        self.edges, self.lp, self.chunks, self.banned, self.rest = edges, lp, chunks, banned, rest
        self.t0 = max(0, len(edges) - 1)


class Sampler:
    def __init__(self, path: str, k: int, seed: int, nodes: int = CACHE_NODES):
        self.vocab = unigram.vocabulary(path)
        self.lattices = Lattices(self.vocab, nodes)
        self.k, self.seed = k, seed

    def draw(self, node, base):
        """Backward draws for many chunks at once, from ``node`` to the chunk's start, by the counter hash ``base``.

        Returns the edges of all steps chunk by chunk, the same in text order, and where each chunk's begin.
        """
        lat = self.lattices
        e = lat.first[node].astype(np.int64)
        who = np.flatnonzero(e >= 0)
        e, base, parts, step = e[who], base[who], [], 0
        while len(who):
            u = to_unit(counter_hash(base, step)).astype(np.float32)
            more = np.flatnonzero(lat.cdf[e] <= u)
            while len(more):
                e[more] += 1
                more = more[lat.cdf[e[more]] <= u[more]]
            parts.append((who, e))
            after = lat.first[lat.prev[e]]
            on = np.flatnonzero(after >= 0)
            who, e, base = who[on], after[on].astype(np.int64), base[on]
            step += 1
        who = np.concatenate([np.empty(0, np.int64), *(w for w, _ in parts)])
        e = np.concatenate([np.empty(0, np.int64), *(x for _, x in parts)])
        st = np.repeat(np.arange(step), [len(w) for w, _ in parts])
        start = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(node)))])
        back, forth = np.empty(len(e), np.int64), np.empty(len(e), np.int64)
        back[start[who] + st] = e
        forth[start[who + 1] - 1 - st] = e
        return back, forth, start

    def samples(self, keys: list[int], texts: list[str]) -> list[list[tuple]]:
        """Per text its samples: (perturbed value, log probability, inclusion, pieces in order)."""
        found, ids, stops = self.search(keys, texts)
        pieces = iter(np.split(ids, stops[:-1]) if len(stops) else ())
        return [[(*x, next(pieces)) for x in rows] for rows in found]

    def search(self, keys: list[int], texts: list[str]) -> tuple[list[list[tuple]], np.ndarray, np.ndarray]:
        """Per text (perturbed value, log probability, inclusion) of its samples; the pieces of all samples, and where each ends."""
        chunks = [self.vocab.chunks(t) for t in texts]
        lat = self.lattices
        if lat.nodes > lat.room:
            lat.reset()
        size = np.array([len(c) for c in chunks], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        end = lat.ends(list(chain.from_iterable(chunks)))
        n = len(texts)
        chunk = np.arange(len(end)) - np.repeat(first[:-1], size)
        key = np.array(keys, np.uint64)
        done: list[list] = [[] for _ in texts]
        leaves: list[list[Leaf]] = [[] for _ in texts]
        rounds: list[tuple] = []
        agenda = Agenda(n)
        # what is opened next: texts, values, leaves without what is drawn behind their heads
        live, value = np.arange(n), -np.log(-np.log(uniform(key, 1 << 20)))
        none = np.empty(0, np.int64)
        new = [Leaf(none, np.empty(0), none) for _ in texts]
        for r in range(self.k):
            if not len(live):
                break
            # drawn anew: the rest of the chunk where an opened set leaves its leaf, and all chunks behind it
            turned = np.array([len(x.edges) > 0 for x in new])
            low, high = first[live], first[live + 1]
            low[turned] = [x.chunks[-1] for x in new if len(x.edges)]
            place = np.concatenate([[0], np.cumsum(high - low)])
            pick = np.arange(place[-1]) + np.repeat(low - place[:-1], high - low)
            node = end[pick]
            node[place[:-1][turned]] = lat.prev[[x.edges[-1] for x in new if len(x.edges)]]
            back, forth, start = self.draw(node, counter_hash(np.repeat(counter_hash(key[live], r), high - low), chunk[pick]))
            lp = lat.lp[back]
            rounds.append((back, forth, start, pick, lp))
            cuts = start[place].tolist()
            for i, d in enumerate(live.tolist()):
                leaf = new[i]
                leaf.a, leaf.b = cuts[i], cuts[i + 1]
                leaf.same = int(start[place[i] + 1]) - leaf.a if turned[i] else 0
                whole = np.concatenate([leaf.lp, lp[leaf.a: leaf.b]]) if turned[i] else lp[leaf.a: leaf.b]
                done[d].append((float(value[i]), float(whole.sum())))
                leaves[d].append(leaf)
            agenda.keep(self.k - r)
            self.push(agenda, live, new, value, lp, counter_hash(key[live], 1 << 21, r), r)
            live, value, rs, ts = agenda.pop()
            if r + 1 < self.k:
                turn_u = uniform(key, 1 << 22, r + 1)
                new = [self.turn(leaves[d][q], t, rounds[q], turn_u[d]) for d, q, t in zip(live.tolist(), rs.tolist(), ts.tolist())]
        # of the (k + 1)-th segmentation only the value is needed
        kappa = np.full(n, -math.inf)
        kappa[live] = value
        ids, stops = self.pieces(leaves, rounds)
        return [[(v, lp, self.inclusion(lp, kp)) for v, lp in x] for x, kp in zip(done, kappa.tolist())], ids, stops

    def push(self, agenda, live, leaves, value, lp, side, r) -> None:
        """The sets beside the leaves of a round: another edge at a step from ``t0`` on.

        Only as many of a text as can still be opened go on its agenda. A set's value lies less than 40 above its log
        mass (the smallest -log u is 2^-53), and the mass of later steps only falls: steps whose mass lies 40 below the
        last value wanted are left out without changing the result.
        """
        t0 = np.array([x.t0 for x in leaves])
        turned = np.array([len(x.edges) > 0 for x in leaves])
        a = np.array([x.a for x in leaves]) - turned
        length = np.array([x.b for x in leaves]) - a
        mass0 = np.array([x.lp[:x.t0].sum() for x in leaves])
        turn_lp = np.array([x.lp[-1] if len(x.lp) else 0.0 for x in leaves])
        turn_rest = np.array([x.rest for x in leaves])
        rows, lo = np.flatnonzero(length > 0), 0
        lp = lp if len(lp) else np.zeros(1)
        while len(rows):
            cols = lo + np.arange(min(WINDOW, int(length[rows].max()) - lo))
            part = lp[np.minimum(a[rows, None] + cols, len(lp) - 1)]
            part[cols >= length[rows, None]] = 0.0
            odd = np.flatnonzero(turned[rows]) if lo == 0 else []
            if len(odd):
                part[odd, 0] = turn_lp[rows[odd]]
            before = mass0[rows, None] + np.cumsum(part, axis=1) - part
            alive = part < 0  # 0: one edge only
            if len(odd):
                alive[odd, 0] = turn_rest[rows[odd]] > 0
            least = agenda.least[live[rows]]
            alive &= before >= least[:, None] - 40
            i, j = np.nonzero(alive)
            rest = -np.expm1(part[i, j])
            if len(odd):
                here = np.flatnonzero((j == 0) & turned[rows[i]])
                rest[here] = turn_rest[rows[i[here]]]
            row, t = rows[i], t0[rows[i]] + lo + j
            mass = before[i, j] + np.log(rest)
            v = -np.logaddexp(-value[row], np.log(-np.log(to_unit(counter_hash(side[row], t)))) - mass)
            good = np.flatnonzero(v > least[i])
            agenda.push(live[row[good]], v[good], r, t[good])
            mass0[rows] += part.sum(axis=1)
            lo += len(cols)
            rows = rows[(length[rows] > lo) & (mass0[rows] >= agenda.least[live[rows]] - 40)]

    def turn(self, leaf: Leaf, t: int, drawn: tuple, u: float) -> Leaf:
        """The head of a new leaf: a leaf up to its step ``t``, and there another edge that isn't banned, by probability."""
        lat, h = self.lattices, len(leaf.edges)
        if t < h:
            edges, lp, chunks, old = (leaf.edges[:t],), (leaf.lp[:t],), leaf.chunks, leaf.edges[t]
        else:
            back, _, start, pick, step_lp = drawn
            stop = leaf.a + t - h
            edges, lp, old = (leaf.edges, back[leaf.a: stop]), (leaf.lp, step_lp[leaf.a: stop]), back[stop]
            chunks = np.concatenate([leaf.chunks, pick[start.searchsorted(np.arange(leaf.a, stop + 1), side="right") - 1]])
        banned = (*(leaf.banned if t == leaf.t0 else ()), int(old))
        into = lat.into(int(lat.prev[old]) + int(lat.lengths[lat.piece[old]]))
        into = into[[e not in banned for e in into.tolist()]]
        into_lp = lat.lp[into]
        p = np.exp(into_lp)
        total = p.cumsum()
        i = min(int(total.searchsorted(u * total[-1], side="right")), len(into) - 1)
        return Leaf(np.concatenate([*edges, into[i: i + 1]]), np.concatenate([*lp, into_lp[i: i + 1]]), chunks, banned,
                    float(np.concatenate([p[:i], p[i + 1:]]).sum()))

    @staticmethod
    def inclusion(total: float, kappa: float) -> float:
        return 1.0 if kappa == -math.inf else -math.expm1(-math.exp(min(total - kappa, 50.0)))

    def pieces(self, leaves: list[list[Leaf]], rounds: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all leaves in text order, and where each leaf's end: chunks in order, steps of a chunk backwards;
        unknown characters as bytes."""
        lat, every = self.lattices, [(x, r) for own in leaves for r, x in enumerate(own)]
        # all heads at once; of their last chunk what was drawn behind them comes first
        size = np.array([len(x.edges) for x, _ in every], np.int64)
        heads = np.concatenate([np.empty(0, np.int64), *(x.edges for x, _ in every)])
        owner = np.repeat(np.arange(len(every)), size)
        chunk = np.concatenate([np.empty(0, np.int64), *(x.chunks for x, _ in every)])
        begins = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (owner[1:] != owner[:-1])])) if len(heads) else heads
        ends = np.append(begins[1:], len(heads))
        heads = heads[np.repeat(begins + ends - 1, ends - begins) - np.arange(len(heads))]
        stops = np.cumsum(size)
        lasts = begins[np.searchsorted(begins, stops - 1, side="right") - 1].tolist() if len(heads) else [0] * len(every)
        parts = [np.empty(0, np.int64)]
        for (x, r), at, last, stop in zip(every, (stops - size).tolist(), lasts, stops.tolist()):
            forth = rounds[r][1]
            if at < stop:
                parts += [heads[at: last], forth[x.a: x.a + x.same], heads[last: stop], forth[x.a + x.same: x.b]]
            else:
                parts.append(forth[x.a: x.b])
        edges = np.concatenate(parts)
        stops = np.cumsum([len(x.edges) + x.b - x.a for x, _ in every])
        ids = lat.piece[edges].astype(np.int32)
        odd = np.flatnonzero(ids == 0)
        if len(odd):
            raw = [lat.unknown[x] for x in (lat.prev[edges[odd]] + 1).tolist()]
            width = np.ones(len(ids), np.int64)
            width[odd] = [len(x) for x in raw]
            last = np.cumsum(width)
            ids, is_byte = np.repeat(ids, width), np.repeat(ids == 0, width)
            ids[is_byte] = np.array(self.vocab.byte_ids, np.int32)[np.frombuffer(b"".join(raw), np.uint8)]
            stops = np.concatenate([[0], last])[stops]
        return ids, stops


class Agenda:
    """Sets that may be opened, by text (row) and falling value: leaf ``r`` of the text, left at step ``t``."""

    def __init__(self, n: int):
        self.row, self.value, self.r, self.t = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64)
        self.least, self.most = np.full(n, -math.inf), 0

    def keep(self, most: int) -> None:
        """At most so many a row; ``least`` is the last one's value, minus infinity where there are fewer."""
        self.most = most
        rank = np.arange(len(self.row)) - np.searchsorted(self.row, self.row)
        last = rank == most - 1
        self.least[:] = -math.inf
        self.least[self.row[last]] = self.value[last]
        self._take(rank < most)

    def _take(self, at) -> None:
        self.row, self.value, self.r, self.t = self.row[at], self.value[at], self.r[at], self.t[at]

    def push(self, row, value, r: int, t) -> None:
        self.row, self.value = np.concatenate([self.row, row]), np.concatenate([self.value, value])
        self.r, self.t = np.concatenate([self.r, np.full(len(row), r)]), np.concatenate([self.t, t])
        self._take(np.lexsort((self.t, self.r, -self.value, self.row)))
        self.keep(self.most)

    def pop(self) -> tuple:
        """Every row's best, which leaves the agenda: rows, values, leaves, steps."""
        best = np.concatenate([[True], self.row[1:] != self.row[:-1]]) if len(self.row) else np.empty(0, bool)
        out = self.row[best], self.value[best], self.r[best], self.t[best]
        self._take(~best)
        return out


def groups(texts: list[str], most: int):
    """Index ranges of consecutive texts of at most ``most`` characters together, one text at least."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and chars + len(t) > most:
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def sample_segmentations(docs: DataFrame, k: int = 2, seed: int = 7, path: str | None = None, with_ids: bool = False,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k distinct segmentations per row: sample (by falling perturbed value), n_pieces, log_prob, perturbed,
    inclusion, ids_crc (CRC-32 of the ids as little-endian int32), decodes (the ids give the text back, with
    every U+2581 read as a space); ``with_ids`` adds the ids."""
    path = path or unigram.default_path()
    ids = docs.select(id_col).schema[0].dataType.simpleString()

    def run(sampler, cols):
        keys, texts = cols[id_col], [t or "" for t in cols[text_col]]
        for a, b in groups(texts, BATCH_CHARS):
            out: dict[str, list] = {c: [] for c in (id_col, "sample", "n_pieces", "log_prob", "perturbed", "inclusion",
                                                   "ids_crc", "decodes", *["ids"] * with_ids)}
            found, ids, stops = sampler.search([row_key(seed, x) for x in keys[a:b]], texts[a:b])
            decoded, places = sampler.vocab.decode_all(ids, stops)
            ends, at, byte = zip(stops.tolist(), places), 0, 0
            for key, text, rows in zip(keys[a:b], texts[a:b], found):
                plain = (" " * bool(text) + text.replace(unigram.MARK, " ")).encode("utf-8", "surrogatepass")
                for s, (value, logp, inclusion) in enumerate(rows):
                    stop, byte_stop = next(ends)
                    pieces = ids[at: stop]
                    row = (key, s, len(pieces), logp, value, inclusion, zlib.crc32(pieces), decoded[byte: byte_stop] == plain,
                           *[pieces] * with_ids)
                    at, byte = stop, byte_stop
                    for name, x in zip(out, row):
                        out[name].append(x)
            yield out

    schema = (f"`{id_col}` {ids}, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, "
              "ids_crc long, decodes boolean" + ", ids array<int>" * with_ids)
    return map_batches(text_rows(docs, id_col, text_col), run, schema, init=lambda: shared_state(("sampler", path, k, seed), lambda: Sampler(path, k, seed)))


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text of every id sequence (null ids: null)."""
    from pyspark.sql import functions as F

    path = path or unigram.default_path()

    @F.pandas_udf("string")
    def text_of(ids):
        vocab = unigram.vocabulary(path)
        return ids.map(lambda x: None if x is None else vocab.decode([int(i) for i in x]))

    return encoded.withColumn(out, text_of(F.col(f"`{ids_col}`")))
