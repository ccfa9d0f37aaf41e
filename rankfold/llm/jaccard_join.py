"""Exact n-gram Jaccard self-join: prefix filters under several global token orders.

Two sets with Jaccard similarity of t or more share a token among the first
n - ceil(t n) + 1 of each, under any order of all tokens. Orders here are
hashes of the shingles. Order 1 makes the candidates (tokens joined by
equality); a candidate must also share prefix tokens under orders 2 and 3
before it is verified on the whole sets.

Steps
1. ``sketch``: one pass over the texts: set size, a 128-bit signature of the
   set, an extended prefix under order 1 and the prefixes under 2 and 3. Texts
   with equal sets become one class (its smallest doc_id), so copies never meet.
2. Tokens held by many classes move to the end of order 1 (the order stays
   global: the move depends on the token only). The extended prefix holds
   enough tokens to see the new prefix; where too many of them have moved, the
   new prefix is taken from the whole set.
3. Tokens with the same members are reduced to one. Groups under ``HOT``
   members give their pairs. The members of larger ones are joined anew among
   themselves with their tokens in rarest-first order, counted over all of
   them: a member's place in a group then tells how many tokens it has that
   hardly anyone shares, and bounds its overlap with the other members. Groups
   that are still large give a star, every member against the pivot; members
   linked to the pivot are connected, and only those that aren't are compared
   with others of the group that the bound allows.
4. Pairs that pass the size and prefix filters are bounded on about a
   byte a shingle, and the few that can still link are verified on their 64-bit
   shingle hashes. Links are joined to components by smallest id.

Documents without words have the empty set, link with nothing and are their own
component. Null texts are such documents. A null doc_id takes no part: its
component is null. Repeated rows are copies. Rows that share a doc_id count as
one document when linking. Words are ASCII-lower-cased. Empty tables give
empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from rankfold.llm.common import ids_side, map_batches, mix, text_rows, written

PERCENT = 85
WIDTH = 4
EXTEND = 1.5
HOT = 20
MEMO_WORDS = 200_000

_U = np.uint64
_ORDERS = (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9))
_SIGNS = (_U(0x27D4EB2F165667C5), _U(0x85EBCA77C2B2AE63))


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word):
        import xxhash

        if len(self) > MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | None, memo: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    if len(w) < width:
        h = np.array([len(w)], np.uint64)
        for i in range(len(w)):
            h = mix(h) + w[i: i + 1]
        return mix(h)
    h = w[: len(w) - width + 1].copy()
    for j in range(1, width):
        h = mix(h)
        h += w[j: len(w) - width + 1 + j]
    return np.unique(mix(h))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n // 100) + 1


def sketch(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n, signature (s1, s2), extended prefix e under order 1, prefixes p2 and p3 as 16-bit tokens."""

    def run(memo, cols):
        out: dict[str, list] = {c: [] for c in ("doc", "n", "s1", "s2", "e", "p2", "p3")}
        for doc, text in zip(cols[id_col], cols[text_col]):
            h = shingles(text, memo, width)
            n, p = len(h), prefix_size(len(h), percent)
            row = [doc, n, 0, 0, None, None, None]
            if n:
                row[2] = int(mix(h ^ _SIGNS[0]).sum(dtype=np.uint64).view(np.int64))
                row[3] = int(np.bitwise_xor.reduce(mix(h ^ _SIGNS[1])).view(np.int64))
                for k, (order, size) in enumerate(zip(_ORDERS, (min(n, int(EXTEND * p) + 1), p, p))):
                    r = mix(h ^ order)
                    r = np.sort(np.partition(r, size - 1)[:size] if size < n else r)
                    row[4 + k] = r.view(np.uint32)[::2].view(np.int32) if k == 0 else r.view(np.uint16)[::4].view(np.int16)
            for c, x in zip(out, row):
                out[c].append(x)
        return out

    ids = docs.select(id_col).schema[0].dataType.simpleString()
    return map_batches(text_rows(docs, id_col, text_col), run,
                       f"doc {ids}, n int, s1 long, s2 long, e array<int>, p2 array<smallint>, p3 array<smallint>", init=WordHashes)


def classes(sketches: DataFrame) -> DataFrame:
    """One row per distinct set: rep (its smallest doc), n, e, p2, p3 and the signature."""
    x = sketches.where("n > 0 and doc is not null")
    return x.groupBy("n", "s1", "s2").agg(F.min("doc").alias("rep"), F.min_by(F.struct("e", "p2", "p3"), "doc").alias("x")).select(
        "rep", "n", "s1", "s2", "x.e", "x.p2", "x.p3")


def _prefix(n, percent: int):
    return n - F.ceil(n * percent / F.lit(100)).cast("int") + 1


def candidate_postings(reps: DataFrame, docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(tok, rep, n): prefix tokens under order 1 with hot tokens moved to its end."""
    posts = reps.select("rep", F.posexplode("e").alias("rank", "tok"))
    shared = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = written(posts.join(shared, "tok"), "jaccard-held")
    # per class: which of its extended prefix is hot; it is stuck if too little else is left of it
    ranks = held.where(F.col("df") >= HOT).groupBy("rep").agg(F.sort_array(F.collect_list("rank")).alias("hot_ranks"))
    sizes = reps.select("rep", "n", F.size("e").alias("ne"), _prefix(F.col("n"), percent).alias("p"))
    per = sizes.join(ranks, "rep", "left").withColumn("hot_ranks", F.coalesce("hot_ranks", F.array().cast("array<int>")))
    per = per.withColumn("plain", F.col("ne") - F.size("hot_ranks"))
    per = per.withColumn("stuck", (F.col("plain") < F.col("p")) & (F.col("ne") < F.col("n")))
    earlier = F.size(F.filter("hot_ranks", lambda r: r < F.col("rank")))
    place = lambda hot: F.when(hot, F.col("plain") + earlier).otherwise(F.col("rank") - earlier)
    usual = held.join(per.where("not stuck"), "rep").where(place(F.col("df") >= HOT) < F.col("p")).select("tok", "rep", "n")
    stuck = written(per.where("stuck").select("rep", "n", "p"), "jaccard-stuck")
    if stuck.isEmpty():
        return usual
    # the stuck ones: their prefix from the whole set
    text = text_rows(docs, id_col, text_col).join(ids_side(stuck.select(F.col("rep").alias("id"))), F.col(id_col) == F.col("id"), "left_semi")
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def ordered(memo, cols):
        sets = (np.sort(mix(shingles(t, memo, width) ^ _ORDERS[0])) for t in cols[text_col])
        return {"rep": cols[id_col], "e": [r.view(np.uint32)[::2].view(np.int32) for r in sets]}

    whole = map_batches(text, ordered, f"rep {kind}, e array<int>", init=WordHashes).distinct()
    whole = whole.select("rep", F.posexplode("e").alias("rank", "tok"))
    hot = held.where(F.col("df") >= HOT)
    one = Window.partitionBy("rep").orderBy("rank")  # the tokens of one document
    cold = whole.join(hot.select("tok").distinct(), "tok", "left_anti").withColumn("at", F.row_number().over(one))
    cold = written(cold.join(stuck, "rep").select("tok", "rep", "n", "p", "at"), "jaccard-cold")
    # where other tokens don't fill the prefix, hot ones follow; the extended prefix holds enough of them
    n_cold = cold.groupBy("rep").agg(F.count(F.lit(1)).alias("n_cold"))
    after = per.where("stuck").join(n_cold, "rep", "left").withColumn("n_cold", F.coalesce("n_cold", F.lit(0))).where("n_cold < p")
    warm = hot.join(after, "rep").where(F.col("n_cold") + earlier < F.col("p")).select("tok", "rep", "n")
    deep = written(cold.where("at <= p").select("tok", "rep", "n").unionByName(warm), "jaccard-deep")
    # tokens of theirs that one other class holds in its prefix
    known = held.select("tok").distinct()
    lone = posts.join(deep.select("tok").distinct(), "tok", "left_semi").join(known, "tok", "left_anti")
    lone = lone.join(per.where("not stuck"), "rep").where(place(F.lit(False)) < F.col("p")).select("tok", "rep", "n")
    return usual.unionByName(deep).unionByName(lone)


def near_size(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def groups_of(posts: DataFrame) -> DataFrame:
    """The postings of one token for each distinct set of members of two or more, with the group's size."""
    sign = lambda seed: F.xxhash64("rep", F.lit(seed))
    g = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("g"), F.bit_xor(sign(1)).alias("x"), F.sum(sign(2).cast("decimal(20,0)")).alias("s"))
    g = g.where("g > 1").groupBy("g", "x", "s").agg(F.min("tok").alias("tok")).select("tok", "g")
    return posts.join(g, "tok")


def packed(h: np.ndarray) -> bytes:
    """About one byte a shingle: the last bits of the hashes (64 values a shingle), sorted, as steps.

    The first byte is the number of bits; a step of 255 or more is written as 255s and the rest.
    """
    bits = min(63, max(6, int(64 * len(h)).bit_length()))
    low = np.sort(h & _U((1 << bits) - 1)).astype(np.int64)
    step = np.diff(low, prepend=0)
    whole = step // 255
    out = np.full(int(whole.sum()) + len(step), 255, np.uint8)
    out[np.cumsum(whole + 1) - 1] = step % 255
    return bytes([bits]) + out.tobytes()


def unpacked(b: bytes) -> tuple[int, np.ndarray]:
    step = np.frombuffer(b, np.uint8, offset=1)
    return b[0], np.cumsum(step, dtype=np.int64)[step != 255]


def sets_of(pairs: DataFrame, docs: DataFrame, width: int, id_col: str, text_col: str, short: bool) -> DataFrame:
    """(id, set) of every document in the pairs: sorted 64-bit hashes, or their packed ends."""
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-wanted")
    text = text_rows(docs, id_col, text_col).join(ids_side(wanted), F.col(id_col) == F.col("id"), "left_semi")

    def run(memo, cols):
        sets = (shingles(t, memo, width) for t in cols[text_col])
        return {"id": cols[id_col], "set": [packed(x) if short else x.tobytes() for x in sets]}

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return map_batches(text, run, f"id {kind}, set binary", init=WordHashes)


def overlaps(pairs: DataFrame, sets: DataFrame, count, out: str) -> DataFrame:
    """The pairs with ``count`` of their two sets as column ``out``."""
    kind = pairs.select("a").schema[0].dataType.simpleString()
    x = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    x = x.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b").select("a", "b", "sa", "sb")
    return map_batches(x, lambda _, c: {"a": c["a"], "b": c["b"], out: [count(p, q) for p, q in zip(c["sa"], c["sb"])]},
                       f"a {kind}, b {kind}, {out} array<int>")


def most_shared(a: bytes, b: bytes) -> list[int]:
    """[upper bound of the intersection, size of a, size of b] from packed ends: an end that the other lacks is no shared shingle."""
    (bits_a, x), (bits_b, y) = unpacked(a), unpacked(b)
    cut = (1 << min(bits_a, bits_b)) - 1
    x, y = x & cut, y & cut
    return [int(min(np.isin(x, y).sum(), np.isin(y, x).sum())), len(x), len(y)]


def shared(a: bytes, b: bytes) -> list[int]:
    """[intersection, size of a, size of b] of sorted distinct 64-bit hashes."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    return [len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)]


def similar(c: str, percent: int):
    """100 * intersection >= percent * union, for [intersection, size, size]."""
    i = F.col(c)[0]
    return i * 100 >= (F.col(c)[1] + F.col(c)[2] - i) * percent


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """The linked pairs (a, b) with j, and those ruled out on their sets with j null.

    Filters in order: prefixes of orders 2 and 3; an upper bound from about a byte a shingle; the whole sets, for the
    few pairs that are left. Only what passed one is sent to the next.
    """
    side = lambda k: reps.select(F.col("rep").alias(k), F.col("p2").alias(f"{k}2"), F.col("p3").alias(f"{k}3"))
    x = pairs.join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("a2", "b2") & F.arrays_overlap("a3", "b3"))
    x = written(x.select("a", "b"), "jaccard-candidates")
    x = overlaps(x, written(sets_of(x, docs, width, id_col, text_col, True), "jaccard-ends"), most_shared, "bound")
    x = written(x.where(similar("bound", percent)).select("a", "b").distinct(), "jaccard-bounded")
    x = overlaps(x, written(sets_of(x, docs, width, id_col, text_col, False), "jaccard-sets"), shared, "found")
    i = F.col("found")[0]
    return x.where(similar("found", percent)).select("a", "b", (i / (F.col("found")[1] + F.col("found")[2] - i)).alias("j")).distinct()


def positional(place_a, place_b, percent: int):
    """Whether sets of na and nb whose first shared token stands at these places (from 0) can still link."""
    most = F.least(F.col("na") - place_a, F.col("nb") - place_b)
    return most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent


def rare_first_postings(members: DataFrame, docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    """(tok, rep, n, own, place) of the members' prefixes under rarest-first order, counted over all members' whole sets.

    ``own`` is the number of a member's tokens that no other member has. They come first in this order.
    """
    text = text_rows(docs, id_col, text_col).join(ids_side(members.select(F.col("rep").alias("id"))), F.col(id_col) == F.col("id"), "left_semi")
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    sets = map_batches(text, lambda memo, c: {"rep": c[id_col], "set": [shingles(t, memo, width).view(np.int64) for t in c[text_col]]},
                       f"rep {kind}, set array<long>", init=WordHashes)
    tokens = written(sets.select("rep", F.explode("set").alias("tok")).distinct(), "jaccard-tokens")
    df = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = tokens.join(df, "tok")
    order = Window.partitionBy("rep").orderBy("df", "tok")  # the tokens of one document
    held = held.withColumn("at", F.row_number().over(order)).withColumn("n_held", F.count(F.lit(1)).over(Window.partitionBy("rep")))
    held = held.join(members, "rep").withColumn("own", F.col("n") - F.col("n_held"))
    held = held.withColumn("place", (F.col("own") + F.col("at") - 1).cast("int"))
    return held.where(F.col("place") < _prefix(F.col("n"), percent)).select("tok", "rep", "n", "own", "place")


def links(docs: DataFrame, reps: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Pairs of class representatives (a < b), enough to connect every two that are linked."""
    posts = written(candidate_postings(reps, docs, percent, width, id_col, text_col).distinct(), "jaccard-postings")
    found = written(groups_of(posts), "jaccard-groups")
    check = lambda x: verified(x.distinct(), docs, reps, percent, width, id_col, text_col)
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    small = found.where(F.col("g") < HOT)
    right = small.select("tok", F.col("rep").alias("b"), F.col("n").alias("nb"))
    pairs = small.withColumnsRenamed({"rep": "a", "n": "na"}).join(right, "tok").where(
        (F.col("a") < F.col("b")) & near_size("na", "nb", percent)).select("a", "b")
    members = written(found.where(F.col("g") >= HOT).select("rep", "n").distinct(), "jaccard-members")
    if members.isEmpty():
        return written(check(pairs).select("a", "b"), "jaccard-links")
    # members of large groups: joined anew among themselves, rarest tokens first
    posts = written(rare_first_postings(members, docs, percent, width, id_col, text_col), "jaccard-rare")
    g = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("g"), F.max(F.struct(-F.col("own") / F.col("n"), "n", "rep")).alias("m")).where("g > 1")
    # the pivot is the member with the smallest share of tokens of its own
    posts = written(posts.join(g.select("tok", "g", F.col("m.rep").alias("pivot"), F.col("m.n").alias("pivot_n")), "tok"), "jaccard-rare-groups")
    few = posts.where(F.col("g") < HOT).withColumnsRenamed({"rep": "a", "n": "na", "place": "pa"}).drop("own", "pivot", "pivot_n", "g")
    right = posts.where(F.col("g") < HOT).select("tok", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"))
    few = few.join(right, "tok").where((F.col("a") < F.col("b")) & near_size("na", "nb", percent) & positional(F.col("pa"), F.col("pb"), percent))
    many = posts.where(F.col("g") >= HOT)
    arms = many.where((F.col("rep") != F.col("pivot")) & near_size("n", "pivot_n", percent)).select(*ordered("rep", "pivot"))
    first = written(check(pairs.unionByName(few.select("a", "b")).unionByName(arms)), "jaccard-first")
    # a member that links to its group's pivot is connected; one that doesn't is compared with the others of the group,
    # where their places in it, and the tokens of their own, allow a link
    on = many.withColumns({"a": F.least("rep", "pivot"), "b": F.greatest("rep", "pivot")}).join(first.select("a", "b", "j"), ["a", "b"], "left")
    on = written(on.where("rep <> pivot").select("tok", "rep", "n", "place", "j"), "jaccard-arms")
    loose = on.where("j is null").select("tok", F.col("rep").alias("u"), F.col("n").alias("na"), F.col("place").alias("pa"))
    other = on.where("j is null or j < 1").select("tok", "rep", F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("j"))
    rest = loose.join(other, "tok").where((F.col("u") != F.col("rep")) & (F.col("j").isNotNull() | (F.col("u") < F.col("rep")))
                                          & near_size("na", "nb", percent) & positional(F.col("pa"), F.col("pb"), percent))
    rest = rest.select(*ordered("u", "rep")).distinct().join(first.select("a", "b"), ["a", "b"], "left_anti")
    return written(first.select("a", "b").unionByName(check(rest).select("a", "b")), "jaccard-links")


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable): smallest neighbour labels, then labels of labels, until they stay."""
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "components-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "components-0")
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("heard"))
        x = labels.join(heard, F.col("node") == F.col("a")).select("node", "component", F.least("component", "heard").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("component").alias("up"))
        x = x.join(up, "low").select("node", F.col("component").alias("old"), F.least("low", "up").alias("component"))
        x = written(x, "components-n")
        labels = x.select("node", "component")
        if x.where("old <> component").isEmpty():
            return labels


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, n_shingles, component of every row."""
    sketches = written(sketch(docs, percent, width, id_col, text_col), "jaccard-sketches")
    reps = written(classes(sketches), "jaccard-classes")
    comp = components(links(docs, reps, percent, width, id_col, text_col))
    to = reps.select("n", "s1", "s2", "rep").join(comp, F.col("rep") == F.col("node"), "left").select(
        "n", "s1", "s2", F.coalesce("component", "rep").alias("to"))
    x = sketches.select("doc", "n", "s1", "s2").join(to, ["n", "s1", "s2"], "left")
    return x.select("doc", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), F.coalesce("to", "doc")).alias("component"))


def op4(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs).select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One document of each component stays (the one of smallest doc_id); null doc_ids stay. All columns are kept."""
    x = written(jaccard_components(docs, percent, width), "near-duplicates")
    gone = written(x.where("doc <> component").select(F.col("doc").alias("id")).distinct(), "near-duplicates-gone")
    on = F.col("own.doc_id") == F.col("ids.id")  # by alias: the documents' columns may have any name
    met = lambda d, ids, how: d.alias("own").join(ids.alias("ids"), on, how)
    left = met(docs, ids_side(gone), "left_anti")
    twice = written(x.where("doc = component").groupBy("doc").count().where("count > 1").select(F.col("doc").alias("id")), "near-duplicates-twice")
    if twice.isEmpty():
        return left
    twice = ids_side(twice)
    return met(left, twice, "left_anti").unionByName(met(left, twice, "left_semi").dropDuplicates(["doc_id"]))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' '))) END AS gs FROM w),
cls AS (SELECT md5(array_to_string(list_sort(gs), chr(10))) AS k, min(doc_id) AS rep, any_value(gs) AS gs, len(any_value(gs)) AS n
  FROM g WHERE len(gs) > 0 GROUP BY 1),
t AS (SELECT rep, n, unnest(gs) AS s FROM cls),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM t a JOIN t b ON a.s = b.s AND a.rep < b.rep
  GROUP BY 1, 2),
e0 AS (SELECT a, b FROM p WHERE 100 * i >= 85 * (na + nb - i)),
e AS (SELECT a, b FROM e0 UNION ALL SELECT b, a FROM e0),
r AS (SELECT DISTINCT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
c AS (SELECT node, min(reach) AS comp FROM r GROUP BY node)
SELECT g.doc_id, len(g.gs)::BIGINT AS n_shingles, coalesce(c.comp, cls.rep, g.doc_id) AS component_id
FROM g LEFT JOIN cls ON len(g.gs) > 0 AND md5(array_to_string(list_sort(g.gs), chr(10))) = cls.k LEFT JOIN c ON c.node = cls.rep
"""
