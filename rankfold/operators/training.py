"""Query-wise splits, negative mining, labelled pairs, profiles.

Sampling is deterministic: every random choice is an md5 of the seed and the
row keys, so a rerun (or a lost executor) yields the same rows, and DuckDB
can recompute the same choice as an oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankfold.session import materialize

_HEX15 = float(16 ** 15)
_HASH_BITS = 60
_RING_BUCKET = 65_536  # ids ranked together when the pool is laid on the ring
_STEP_BLOCK = 65_536  # walk steps ranked together; bounds the rows of one window task


def md5_long(*parts) -> Column:
    """First 15 hex digits of md5(parts joined by '|') as BIGINT (same value in DuckDB)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    s = F.concat_ws("|", *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(s), 1, 15), 16, 10).cast("long")


def md5_unit(*parts) -> Column:
    """md5_long scaled to [0, 1)."""
    return md5_long(*parts).cast("double") / F.lit(_HEX15)


def split_by_query(judged: DataFrame, n_test: int):
    """The ``n_test`` queries with most judged rows are the test set
    (ties by query_id); returns (train, test). The id list is a top-n (bounded
    by ``n_test``), applied with semi/anti joins."""
    counts = judged.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    test_ids = counts.orderBy(F.desc("n"), F.asc("query_id")).limit(n_test).select("query_id")
    test = judged.join(F.broadcast(test_ids), "query_id", "left_semi")
    train = judged.join(F.broadcast(test_ids), "query_id", "left_anti")
    return train, test


def _dense_positions(hashed: DataFrame, keys: list[str], size: int) -> DataFrame:
    """``keys`` and their dense position 0..size-1 in the order of hash ``h`` (then keys), without a global sort.

    Hash range buckets are ranked locally; bucket offsets come from a cumulative
    sum over the bucket counts. The number of buckets (a power of two) grows with
    the rows, about ``_RING_BUCKET`` each.
    """
    bits = min(59, max(4, (size // _RING_BUCKET).bit_length()))
    h = hashed.withColumn("bucket", F.shiftright("h", _HASH_BITS - bits))
    # Counts of buckets are summed in two levels, so no window holds all buckets.
    counts = (h.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("top", F.shiftright("bucket", bits // 2)))
    tops = counts.groupBy("top").agg(F.sum("c").alias("n"))
    tops = tops.select("top", (F.sum("n").over(Window.orderBy("top")) - F.col("n")).alias("base"))
    inner = F.sum("c").over(Window.partitionBy("top").orderBy("bucket")) - F.col("c")
    offsets = (counts.withColumn("inner", inner).join(tops, "top")
               .select("bucket", (F.col("base") + F.col("inner")).alias("off")))
    local = F.row_number().over(Window.partitionBy("bucket").orderBy("h", *keys)) - 1
    return (h.withColumn("local", local).join(offsets, "bucket")
            .select(*keys, (F.col("off") + F.col("local")).alias("pos")))


def negative_pairs(judged: DataFrame, seed: int = 42) -> DataFrame:
    """L3: per query, as many negatives as it has positives.

    Pool = distinct documents judged for any query of ``judged``. The pool is
    laid on a ring in md5 order; query q starts at md5(seed, q) mod P and walks
    2*n_pos positions (at most P), dropping its own positives, and keeps the
    first n_pos. Rows produced are linear in the judged table - no
    query x pool product. Only ids take part; query and text are attached to
    the kept rows. Output: query_id, doc_id, query, text, label (0).
    A query gets fewer negatives only when the pool itself is too small.
    """
    pos_pairs = materialize(judged.select("query_id", "doc_id").distinct(), "judged-ids")
    pool = pos_pairs.select("doc_id").distinct()
    p = pool.count()
    ring = _dense_positions(pool.select("doc_id", md5_long(F.lit(seed), F.lit("d"), F.col("doc_id")).alias("h")), ["doc_id"], p)
    per_q = pos_pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_pos"))
    start = F.pmod(md5_long(F.lit(seed), F.lit("q"), F.col("query_id")), F.lit(max(p, 1)).cast("long"))
    walk = F.least(2 * F.col("n_pos"), F.lit(p).cast("long"))
    # A query may own a third of all judged rows: its walk is cut into blocks,
    # the blocks are spread over tasks, and only then become single steps.
    first = F.col("block") * _STEP_BLOCK
    steps = (per_q.withColumn("start", start).withColumn("walk", walk)
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.floor((F.col("walk") - 1) / _STEP_BLOCK))))
             .repartition("query_id", "block")
             .withColumn("j", F.explode(F.sequence(first, F.least(F.col("walk"), first + _STEP_BLOCK) - 1)))
             .select("query_id", "n_pos", "block", "j",
                     F.pmod(F.col("start") + F.col("j"), F.lit(max(p, 1)).cast("long")).alias("pos")))
    cand = materialize(steps.join(ring, "pos").join(pos_pairs, ["query_id", "doc_id"], "left_anti")
                       .select("query_id", "doc_id", "n_pos", "block", "j"), "negative-steps")
    # Keep the first n_pos surviving steps of each query, ranked inside blocks and
    # shifted by the counts of earlier blocks (never one window over a query).
    per_block = cand.groupBy("query_id", "block").agg(F.count(F.lit(1)).alias("c"))
    offsets = per_block.select(
        "query_id", "block",
        (F.sum("c").over(Window.partitionBy("query_id").orderBy("block")) - F.col("c")).alias("before"))
    in_block = F.row_number().over(Window.partitionBy("query_id", "block").orderBy("j"))
    ranked = cand.withColumn("_r", in_block).join(offsets, ["query_id", "block"])
    kept = ranked.where(F.col("before") + F.col("_r") <= F.col("n_pos")).select("query_id", "doc_id")
    # Left joins on grouped keys: the optimizer drops them where only ids are read.
    names = judged.groupBy("query_id").agg(F.first("query").alias("query"))
    texts = judged.groupBy("doc_id").agg(F.min("text").alias("text"))
    return (kept.join(names, "query_id", "left").join(texts, "doc_id", "left")
            .select("query_id", "doc_id", "query", "text", F.lit(0).alias("label")))


def training_pairs(judged: DataFrame, seed: int = 42) -> DataFrame:
    """Positives (label 1) + mined negatives (label 0)."""
    pos = (judged.select("query_id", "doc_id", "query", "text").dropDuplicates(["query_id", "doc_id"])
           .withColumn("label", F.lit(1)))
    return pos.unionByName(negative_pairs(judged, seed))


def group_split(pairs: DataFrame, frac: float = 0.25, seed: int = 42, exact: bool = False):
    """L4/H8: sample ``frac`` of the pair rows by row hash; every query hit goes to
    train, all other queries to validation. Returns (train, validation).

    ``exact`` takes floor(rows * frac) rows, those first in hash order; otherwise
    the sample has that size on average, without a pass for the row count.
    """
    if exact:
        keys = ["query_id", "doc_id", "label"]
        n = pairs.count()
        hashed = pairs.select(*keys, md5_long(F.lit(seed), *[F.col(c) for c in keys]).alias("h"))
        hit = _dense_positions(hashed, keys, n).where(F.col("pos") < int(n * frac))
    else:
        hit = pairs.where(md5_unit(F.lit(seed), F.col("query_id"), F.col("doc_id"), F.col("label")) < frac)
    ids = hit.select("query_id").distinct()
    return (pairs.join(ids, "query_id", "left_semi"), pairs.join(ids, "query_id", "left_anti"))


def label_profile(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows per label of every named pair table."""
    from functools import reduce

    rows = [df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "label", "n")
            for name, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)


def labelled_pairs(pairs: DataFrame, max_chars: int | None = None) -> DataFrame:
    """(query, text, label INT); texts are whole unless ``max_chars`` asks for a cut."""
    lab = F.col("label")
    if dict(pairs.dtypes).get("label") == "string":
        lab = F.when(F.col("label") == "yes", 1).when(F.col("label") == "no", 0)
    text = F.col("text") if max_chars is None else F.substring("text", 1, max_chars).alias("text")
    return pairs.select("query_id", "doc_id", "query", text, lab.cast("int").alias("label"))


def split_profile(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows, distinct queries, distinct documents per named table."""
    from functools import reduce

    rows = [df.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct("query_id").alias("n_queries"),
                   F.countDistinct("doc_id").alias("n_docs")).select(F.lit(name).alias("part"), "*")
            for name, df in parts.items()]
    return reduce(DataFrame.unionByName, rows)
