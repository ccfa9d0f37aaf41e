"""Temperature mixing: source token shares raised to an exponent, realised as block permutations.

Weights are q_s^a / sum q^a of the sources' token shares q. The exponent is
found by bisection (32 points a round, each round one aggregation over the
sources): the largest a in [0, 1] whose entropy reaches the target, raised if
need be to the smallest a at which no source is repeated more often than the
limit. Each source's budget is its weight times the total. A budget of f whole
passes and a rest is realised as f epochs of the source and a part of another:
the documents of an epoch are permuted by dealing them to blocks by a hash of
(seed, epoch, doc_id) and ordering blocks, and documents in a block by hash;
the last epoch stops before the document that would pass the budget.

Only block sums are ordered per source, and documents within the one block
where the budget ends, so no window holds a whole source. The texts are never
shuffled: the cut is a threshold per source, joined to the documents.

Null source: a source of its own. Null text: 0 tokens. Null doc_id: hashed as
the empty id. Rows that share a doc_id share a hash and stand or fall together.
Sources without tokens have share 0 and are passed on once. Empty input:
empty result. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankfold.llm.common import written

WORDS = r"[^\x20\x09-\x0D]+"
POINTS, ROUNDS = 32, 4
BLOCK_DOCS = 1024
TARGET_ENTROPY = 0.95  # of the largest possible, log(number of sources)
MAX_REPEATS = 4.0
SEED = 11


def draw(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A 60-bit number by seed, epoch and document."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_stats(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """_mix_source, docs and tokens per source (written: a row per source)."""
    x = docs.select(F.col(f"`{source_col}`").alias("_mix_source"),
                    F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORDS)), F.lit(0)).cast("long").alias("_mix_tokens"))
    return written(x.groupBy("_mix_source").agg(F.count(F.lit(1)).alias("_mix_docs"), F.sum("_mix_tokens").alias("_mix_n")), "mix-stats")


def curve(stats: DataFrame, total: int, points: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy and largest repetition at each exponent."""
    x = stats.where("_mix_n > 0").select((F.col("_mix_n") / F.lit(float(total))).alias("q"),
                                         F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("a"))
    power = F.pow("q", "a")
    x = x.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.log("q")).alias("l"), F.max(power / F.col("q")).alias("r"))
    rows = x.select("a", F.log("z") - F.col("a") * F.col("l") / F.col("z"), F.col("r") / F.col("z")).collect()
    return {r[0]: (r[1], r[2]) for r in rows}  # POINTS + 1 rows


def bisect(stats: DataFrame, total: int, accept) -> float:
    """The exponent where ``accept(entropy, repeats)`` changes from true to false (or 1 if it never does)."""
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * i / POINTS for i in range(POINTS + 1)]
        got = curve(stats, total, points)
        last = max((i for i, p in enumerate(points) if accept(*got[p])), default=0)
        if last == POINTS:
            return hi
        lo, hi = points[last], points[last + 1]
    return lo


def exponent(stats: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    n, total = stats.where("_mix_n > 0").agg(F.count(F.lit(1)), F.sum("_mix_n")).first()
    if not total:
        return 1.0
    goal = target_entropy * math.log(n) - 1e-12
    by_entropy = bisect(stats, total, lambda h, r: h >= goal)
    by_repeats = bisect(stats, total, lambda h, r: r > max_repeats)
    return round(max(by_entropy, by_repeats), 6)


def budgets(stats: DataFrame, alpha: float, total_tokens: int | None = None) -> DataFrame:
    """Per source: weight, budget, whole passes, rest and number of blocks. One row a source."""
    got = stats.agg(F.sum("_mix_n"), F.sum(F.when(F.col("_mix_n") > 0, F.pow(F.col("_mix_n"), F.lit(alpha))))).first()
    total, z = got[0] or 0, got[1] or 1.0
    goal = total if total_tokens is None else total_tokens
    weight = F.when(F.col("_mix_n") > 0, F.pow(F.col("_mix_n"), F.lit(alpha)) / F.lit(z)).otherwise(0.0)
    x = stats.withColumn("_mix_weight", F.round(weight, 9))
    x = x.withColumn("_mix_budget", F.floor(F.col("_mix_weight") * F.lit(float(goal)) + F.lit(0.5)).cast("long"))
    some = F.col("_mix_n") > 0
    x = x.withColumn("_mix_full", F.when(some, F.floor(F.col("_mix_budget") / F.col("_mix_n"))).otherwise(1).cast("long"))
    x = x.withColumn("_mix_rest", F.when(some, F.col("_mix_budget") - F.col("_mix_full") * F.col("_mix_n")).otherwise(-1))
    return x.withColumn("_mix_blocks", F.ceil(F.col("_mix_docs") / BLOCK_DOCS).cast("long"))


def realise(docs: DataFrame, plan: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
            text_col: str = "text") -> DataFrame:
    """The documents as often as their source's budget says: ``doc`` (a struct of all input columns), epoch, block, position, n_tokens.

    Packed as one column, the documents' own columns can't clash with those of the plan.
    """
    x = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    doc, source, text = (F.col("doc")[c] for c in (id_col, source_col, text_col))
    on = source.eqNullSafe(F.col("_mix_key"))
    keyed = plan.select(F.col("_mix_source").alias("_mix_key"), "_mix_full", "_mix_rest", "_mix_blocks")
    tokens = F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
    id_text = F.coalesce(doc.cast("string"), F.lit(""))
    # the part of an epoch: where the rest of the budget ends
    part = x.join(keyed, on).where("_mix_rest > 0")
    part = part.select("_mix_key", "_mix_rest", tokens.alias("_mix_tokens"), id_text.alias("_mix_id"), draw(seed, F.col("_mix_full"), doc).alias("_mix_order"),
                       "_mix_blocks").withColumn("_mix_block", F.col("_mix_order") % F.col("_mix_blocks"))
    part = written(part.drop("_mix_blocks"), "mix-part")
    # blocks of a source in order; a null source is a key like any other
    sums = part.groupBy("_mix_key", "_mix_rest", "_mix_block").agg(F.sum("_mix_tokens").alias("s"))
    run = F.sum("s").over(Window.partitionBy("_mix_key").orderBy("_mix_block"))
    sums = sums.withColumn("after", run).withColumn("before", F.col("after") - F.col("s"))
    cut = sums.where("before <= _mix_rest and after > _mix_rest")
    cut = cut.select(F.col("_mix_key").alias("k"), F.col("_mix_block").alias("cut_block"), (F.col("_mix_rest") - F.col("before")).alias("room"))
    edge = part.join(cut, F.col("_mix_key").eqNullSafe(F.col("k")) & (F.col("_mix_block") == F.col("cut_block")))
    within = Window.partitionBy("k").orderBy("_mix_order", "_mix_id")  # ties together
    edge = edge.withColumn("used", F.sum("_mix_tokens").over(within)).where("used <= room")
    last = edge.groupBy("k").agg(F.max(F.struct("_mix_order", "_mix_id")).alias("cut_last"))
    cuts = cut.select("k", "cut_block").join(last.withColumnRenamed("k", "lk"), F.col("k").eqNullSafe(F.col("lk")), "left").drop("lk")
    cuts = written(keyed.join(cuts, F.col("_mix_key").eqNullSafe(F.col("k")), "left").drop("k"), "mix-cuts")  # a row a source
    x = x.join(cuts, on).withColumn("_mix_part", draw(seed, F.col("_mix_full"), doc))
    block = F.col("_mix_part") % F.col("_mix_blocks")
    under = F.struct(F.col("_mix_part").alias("_mix_order"), id_text.alias("_mix_id")) <= F.col("cut_last")
    extra = (F.col("_mix_rest") > 0) & (F.col("cut_block").isNull() | (block < F.col("cut_block"))
                                        | ((block == F.col("cut_block")) & F.coalesce(under, F.lit(False))))
    copies = F.col("_mix_full") + F.when(extra, 1).otherwise(0)
    x = x.withColumn("_mix_copies", copies).where("_mix_copies > 0")
    x = x.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_copies") - 1)))
    x = x.withColumn("position", draw(seed, F.col("epoch"), doc))
    return x.select("doc", "epoch", (F.col("position") % F.col("_mix_blocks")).alias("block"), "position", tokens.alias("n_tokens"))


def placed(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: int = SEED,
           total_tokens: int | None = None) -> DataFrame:
    """The mixed documents as ``doc`` structs with their epoch, block, position and n_tokens."""
    stats = source_stats(docs)
    plan = budgets(stats, exponent(stats, target_entropy, max_repeats), total_tokens)
    return realise(docs, plan, seed)


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The mixed documents with the columns of the input, whatever their names."""
    return placed(docs, **kw).select("doc.*")


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, seed: int = SEED,
        total_tokens: int | None = None) -> DataFrame:
    """The mixed documents: all input columns and _mix_epoch, _mix_block, _mix_order, _mix_tokens (in place of input columns so named)."""
    x = placed(docs, target_entropy, max_repeats, seed, total_tokens)
    own = {"_mix_epoch": "epoch", "_mix_block": "block", "_mix_order": "position", "_mix_tokens": "n_tokens"}
    return x.select(*[F.col("doc")[c].alias(c) for c in docs.columns if c not in own], *[F.col(c).alias(n) for n, c in own.items()])


def op10(docs: DataFrame) -> DataFrame:
    return placed(docs).select("doc.doc_id", "doc.source", "epoch", "block", "position", "n_tokens")


def _oracle() -> str:
    rounds = []
    for goal, name in (("e.h >= 0.95 * ln((SELECT count(*) FROM s WHERE n > 0)) - 1e-12", "a"), ("e.r > 4.0", "b")):
        rounds.append(f"{name}0 AS (SELECT 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, false AS done)")
        for i in range(ROUNDS):
            rounds.append(f"""{name}g{i} AS (SELECT i, lo + (hi - lo) * i / {POINTS} AS a FROM {name}{i}, range({POINTS + 1}) t(i)),
{name}e{i} AS (SELECT i, a, ln(sum(pow(q, a))) - a * sum(pow(q, a) * ln(q)) / sum(pow(q, a)) AS h, max(pow(q, a) / q) / sum(pow(q, a)) AS r
  FROM {name}g{i}, s WHERE n > 0 GROUP BY i, a),
{name}l{i} AS (SELECT coalesce(max(i) FILTER ({goal}), 0) AS last FROM {name}e{i} e),
{name}{i + 1} AS (SELECT CASE WHEN p.done OR last = {POINTS} THEN p.hi ELSE (SELECT a FROM {name}g{i} WHERE i = last) END AS lo,
  CASE WHEN p.done OR last = {POINTS} THEN p.hi ELSE (SELECT a FROM {name}g{i} WHERE i = last + 1) END AS hi, p.done OR last = {POINTS} AS done
  FROM {name}{i} p, {name}l{i})""")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS t FROM documents),
s0 AS (SELECT source, count(*) AS docs, sum(t)::BIGINT AS n FROM d GROUP BY source),
s AS (SELECT *, n::DOUBLE / (SELECT sum(n) FROM s0)::DOUBLE AS q FROM s0),
{", ".join(rounds)},
al AS (SELECT round(greatest(a{ROUNDS}.lo, b{ROUNDS}.lo), 6) AS al FROM a{ROUNDS}, b{ROUNDS}),
p1 AS (SELECT source, docs, n, round(pow(n, al) / (SELECT sum(pow(n, al)) FROM s, al WHERE n > 0), 9) AS w FROM s, al WHERE n > 0),
p2 AS (SELECT *, floor(w * (SELECT sum(n) FROM s)::DOUBLE + 0.5)::BIGINT AS budget, ceil(docs / {BLOCK_DOCS})::BIGINT AS blocks FROM p1),
p AS (SELECT *, budget // n AS f, budget % n AS rest FROM p2),
e AS (SELECT d.*, p.f, p.rest, p.blocks, unnest(range(0, p.f + 1)) AS epoch FROM d JOIN p USING (source)),
h AS (SELECT *, ('0x' || substr(md5('{SEED}:' || epoch || ':' || doc_id), 1, 15))::BIGINT AS o FROM e),
b AS (SELECT *, o % blocks AS block FROM h),
c AS (SELECT *, sum(t) OVER (PARTITION BY source, epoch ORDER BY block, o, doc_id::VARCHAR RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used FROM b)
SELECT doc_id, source, epoch::BIGINT AS epoch, block::BIGINT AS block, o AS position, t::BIGINT AS n_tokens
FROM c WHERE epoch < f OR (rest > 0 AND used <= rest)
"""


ORACLE = _oracle()
