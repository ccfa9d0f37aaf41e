"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A row descends the tree level by level. At each node every child draws a number
from a hash of (seed, child, key), u in (0, 1), and the child with the smallest
-ln(u) / weight takes the row, so children take rows in proportion to their
weights, and a child whose weight changes only takes rows from its siblings or
gives them up. An inner node's weight is the sum of its shards' weights unless
a capacity is given. Movement is so confined to the subtrees whose weights change:

* ``reweighted`` changes one shard's weight. With ``hold=True`` the capacities of
  its rack and region stay, and rows move only within the rack.
* ``grown`` opens a new region for the new shard. No other node's weight or
  children change but the root's, so rows move into the new shard only. (A
  shard added to a region whose weight rises with it would draw rows into the
  region's old shards too.)

Where a row goes depends on its key and the tree alone, never on other rows, so
placing shuffles nothing, and the texts stay where they are.

``slots`` numbers the rows of each shard from 0 without gaps: equal rows are
counted first, the distinct ones are dealt to buckets by the leading bits of a
hash, buckets of a shard get offsets from their counts, and only a bucket's rows
are ordered together. A hot key or many equal rows are never one task's window.

Null key: a key of its own. Null text: no bytes, size 1, CRC 0. Rows with equal
keys share a shard. Equal rows: slots of their own, interchangeable. Empty
input: empty result. Further columns stay (``place``) or are left out (``op11``),
whatever their names. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankfold.llm.common import written
from rankfold.llm.oracle_parts import CRC_TABLE, crc32, md5_bits
from rankfold.session import fits

SEED = 17
#: Rows of a slot bucket on average; equal rows of which more than this are numbered in parts.
BUCKET_ROWS = 4_096
_BITS = 52  # of a draw: 13 hexadecimal digits


@dataclass(frozen=True)
class Tree:
    """``regions[region][rack][shard]`` is a shard's weight; ``capacity[path]`` overrides the sum for 'region' or 'region/rack'."""

    regions: dict[str, dict[str, dict[int, float]]]
    capacity: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        seen = [s for racks in self.regions.values() for shards in racks.values() for s in shards]
        if len(seen) != len(set(seen)):
            raise ValueError("a shard number occurs twice in the tree")
        if any(w < 0 for racks in self.regions.values() for shards in racks.values() for w in shards.values()):
            raise ValueError("a weight is negative")
        if not self.children()[""]:
            raise ValueError("no shard of the tree has a weight above 0")

    def shards(self) -> list[int]:
        return sorted(s for racks in self.regions.values() for shards in racks.values() for s in shards)

    def children(self) -> dict[str, list[tuple[str, float, int]]]:
        """Per inner node's path ('' is the root): (path, weight, shard number or -1) of its children of weight above 0."""
        out: dict[str, list[tuple[str, float, int]]] = {"": []}
        for region, racks in self.regions.items():
            total, inner = 0.0, []
            for rack, shards in racks.items():
                path = f"{region}/{rack}"
                leaves = [(f"{path}/{s}", float(w), s) for s, w in sorted(shards.items()) if w > 0]
                weight = float(sum(w for _, w, _ in leaves))
                if leaves:
                    inner.append((path, float(self.capacity.get(path, weight)), -1))
                    out[path] = leaves
                total += weight
            if inner:
                out[region] = inner
                out[""].append((region, float(self.capacity.get(region, total)), -1))
        return out


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """One more shard, the next number, in a region of its own."""
    shard = max(tree.shards()) + 1
    return Tree({**tree.regions, f"g{shard}": {"r0": {shard: weight}}}, dict(tree.capacity))


def reweighted(tree: Tree, shard: int, weight: float, hold: bool = False) -> Tree:
    """``shard`` with another weight; with ``hold`` its rack and region keep what they weigh now."""
    regions = {g: {r: dict(shards) for r, shards in racks.items()} for g, racks in tree.regions.items()}
    capacity = dict(tree.capacity)
    before = {path: w for kids in tree.children().values() for path, w, _ in kids}
    for g, racks in regions.items():
        for r, shards in racks.items():
            if shard in shards:
                shards[shard] = weight
                if hold:
                    capacity |= {g: before[g], f"{g}/{r}": before[f"{g}/{r}"]}
                return Tree(regions, capacity)
    raise ValueError(f"no shard {shard} in the tree")


def draw(*parts) -> Column:
    """A 52-bit number from the MD5 of the parts, joined by colons."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


def descend(key: Column, tree: Tree, seed: int = SEED) -> Column:
    """A struct (path, shard) for each row: three levels of weighted draws."""
    children = tree.children()

    def kids(nodes: list[tuple[str, float, int]]) -> Column:
        return F.array(*[F.struct(F.lit(p).alias("path"), F.lit(w).alias("weight"), F.lit(s).alias("shard")) for p, w, s in nodes])

    def choose(options: Column) -> Column:
        def score(c: Column) -> Column:
            u = (draw(str(seed), c["path"], key) + F.lit(0.5)) / F.lit(float(1 << _BITS))
            return F.struct((-F.log(u) / c["weight"]).alias("score"), c["path"].alias("path"), c["shard"].alias("shard"))

        return F.array_min(F.transform(options, score))

    at = choose(kids(children[""]))
    for depth in (1, 2):
        inner = [p for p in children if p and p.count("/") == depth - 1]
        table = F.create_map(*[x for p in inner for x in (F.lit(p), kids(children[p]))])
        at = choose(F.element_at(table, at["path"]))
    return F.struct(at["path"].alias("path"), at["shard"].alias("shard"))


def _key(col: str) -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit("null"))


def place(df: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard", seed: int = SEED) -> DataFrame:
    """``df`` with each row's place, a struct column ``out`` of (path, shard); nothing is shuffled."""
    return df.withColumn(out, descend(_key(key), tree, seed))


def slots(df: DataFrame, shard: str, by: list[str], seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The columns ``by`` of every row, ``shard`` and ``slot``: 0, 1, 2, ... within each shard.

    ``shard`` follows from ``by``. Rows are ordered by a hash of ``by``, then by ``by``.
    """
    order = draw(str(seed), "slot", *[_key(c) for c in by])
    rows = df.groupBy(*by, shard).agg(F.count(F.lit(1)).alias("copies")).withColumn("place", order)
    rows = written(rows, "tree-rows")
    n, most = rows.agg(F.sum("copies"), F.max("copies")).first()
    n_shards = rows.select(shard).distinct().count()
    bits = max(0, ((n or 0) // (max(1, n_shards) * bucket_rows)).bit_length())
    rows = rows.withColumn("bucket", F.shiftright("place", _BITS - bits))
    counts = rows.groupBy(shard, "bucket").agg(F.sum("copies").alias("m"))
    before = F.sum("m").over(Window.partitionBy(shard).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = written(counts.select(shard, "bucket", F.coalesce(before, F.lit(0)).alias("offset")), "tree-offsets")
    small = F.broadcast(offsets) if fits(offsets) else offsets
    inside = Window.partitionBy(shard, "bucket").orderBy("place", *by)
    rows = rows.withColumn("first", F.sum("copies").over(inside) - F.col("copies")).join(small, [shard, "bucket"])
    rows = rows.select(*by, shard, (F.col("offset") + F.col("first")).alias("first"), "copies")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(bucket_rows).cast("long")))
    rows = rows.withColumn("part", parts)
    if (most or 0) > bucket_rows:
        rows = rows.repartition(shard, "first", "part")
    last = F.least(F.col("part") + F.lit(bucket_rows), F.col("copies")) - 1
    first = F.col("first")
    return rows.select(*by, shard, F.explode(F.sequence(first + F.col("part"), first + last)).alias("slot"))


#: Eight shards of weight 1 in two regions of unequal size.
TREE = Tree({"a": {"r0": {0: 1.0, 1: 1.0, 2: 1.0}, "r1": {3: 1.0, 4: 1.0}}, "b": {"r0": {5: 1.0, 6: 1.0}, "r1": {7: 1.0}}})


def op11(docs: DataFrame, tree: Tree = TREE, text: str = "text") -> DataFrame:
    """Law ``key``: every document's shard, slot and shard with one more shard."""
    t = F.col(f"`{text}`")
    x = docs.select("doc_id", (F.coalesce(F.octet_length(t), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
                    F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"))
    x = place(place(x, tree), grown(tree), out="more")
    x = x.select("doc_id", "size", "text_crc32", F.col("shard.path").alias("path"), F.col("shard.shard").alias("shard"),
                 F.col("more.shard").alias("grown_shard"))
    x = slots(x, "shard", ["doc_id", "size", "text_crc32", "grown_shard", "path"])
    part = F.split("path", "/")
    return x.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                    part[0].alias("region"), part[1].alias("rack"))


def _oracle() -> str:
    def options(nodes):
        return "[" + ", ".join(f"{{'path': '{p}', 'weight': {w!r}::DOUBLE, 'shard': {s}}}" for p, w, s in nodes) + "]"

    def chosen(opts):
        u = f"({md5_bits(f"'{SEED}:' || c.path || ':' || key")} + 0.5) / {float(1 << _BITS)!r}"
        return f"list_min(list_transform({opts}, lambda c: {{'score': -ln({u}) / c.weight, 'path': c.path, 'shard': c.shard}}))"

    ctes, last = [], "d0"
    for name, tree in (("at", TREE), ("more", grown(TREE))):
        children = tree.children()
        for depth in range(3):
            if depth == 0:
                opts = options(children[""])
            else:
                inner = [p for p in children if p and p.count("/") == depth - 1]
                opts = f"CASE {name}{depth - 1}.path " + " ".join(f"WHEN '{p}' THEN {options(children[p])}" for p in inner) + " END"
            ctes.append(f"{name}_{depth} AS (SELECT *, {chosen(opts)} AS {name}{depth} FROM {last})")
            last = f"{name}_{depth}"
    by = "coalesce(doc_id::VARCHAR, 'null') || ':' || size || ':' || text_crc32 || ':' || grown_shard || ':' || path"
    return f"""
WITH {CRC_TABLE},
d0 AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS key, coalesce(strlen(text), 0) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents, crc_table),
{", ".join(ctes)},
p AS (SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, at2.shard::INTEGER AS shard, at2.path AS path, more2.shard::INTEGER AS grown_shard FROM {last}),
o AS (SELECT *, {md5_bits(f"'{SEED}:slot:' || " + by)} AS place FROM p)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY place, doc_id NULLS FIRST, size, text_crc32, grown_shard, path) - 1 AS slot,
  grown_shard, split_part(path, '/', 1) AS region, split_part(path, '/', 2) AS rack FROM o
"""


ORACLE = _oracle()
