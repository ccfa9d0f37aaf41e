"""Conversation structure repair by run-length dynamic programming.

A conversation's rows, in order of turn, become symbols (role class, fault).
Edits (keep, rerole, delete, insert) turn its role initials into
``(s?(ua)+)?`` at the smallest cost. The position in that pattern is one of four
states, and what a row can do is a 4 x 4 min-plus transition matrix per symbol.

Equal consecutive symbols are one run; a run of length n is the symbol's matrix
to the n-th power, put together from cached binary powers. A conversation may
hold a third of all rows, so no task gathers one:

1. Rows are laid out by range of (conversation, turn, role, text) and numbered.
   Each part's piece of a conversation, a *fragment*, is collapsed to runs and
   multiplied to one matrix.
2. Per conversation the fragments' matrices give, from last to first, the cost
   that remains after each fragment.
3. Each fragment unrolls its choices for every state it may be entered in: at
   each row the ASCII-least edit that keeps to the cheapest cost.
4. Per conversation, from first to last, the states of entry pick the audits.
5. The audits are applied to the rows; the repaired rows stream in order through
   the hash, one at a time.

Between steps only matrices and states of fragments are gathered, a few numbers
per fragment (thousands of rows), and never a conversation's rows or texts.

Nulls count as one space in role, text and the damage key; a null turn comes
first and is no part of the gaps; a null conversation id is a conversation.
Rows of equal turn are ordered by role, then text; equal rows are counted, not
listed. A role that is empty or begins with another letter than s, u or a can't
be kept. Very long texts: whole. Empty table: empty result. Further columns are
left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from rankfold.llm.common import forget, hand_back, slices, written
from rankfold.llm.oracle_parts import CRC_TABLE, crc32
from rankfold.session import table_size

#: Rows and bytes of a part, about.
PART_ROWS, PART_BYTES = 20_000, 16 * 1024 * 1024
DELETE, RETYPE, INSERT, TRUNCATED = 4, 3, 3, 3
_BLANKS = " \t\n\x0b\x0c\r"

# ------------------------------------------------------------------ the automaton

#: States: nothing yet, after a system row, after a user row, after an assistant row. The first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or reroled row; its role follows from it.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40
Vector = tuple[int, int, int, int]
#: Cost from each state to the end when no row is left.
END: Vector = (0, 2 * INSERT, INSERT, 0)
#: Symbols: 0 must be deleted; else 1 + 2 * role class (s, u, a, other) + truncated.
MUST_DELETE = 0


def kept(symbol: int, state: int) -> int | None:
    """The state after keeping a row."""
    role = (symbol - 1) // 2
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state) of what a row can do without inserts before it, in ASCII order."""
    out = [("D", DELETE, state)]
    if symbol != MUST_DELETE:
        more = TRUNCATED * ((symbol - 1) % 2)
        to = kept(symbol, state)
        if to is not None:
            out.append(("K", more, to))
        out.append(("R", RETYPE + more, NEXT[state]))
    return out


Matrix = tuple[Vector, Vector, Vector, Vector]
ONE: Matrix = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=65_536)
def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


@lru_cache(maxsize=None)  # 9 symbols, and as many powers as a length has bits
def power(symbol: int, bit: int) -> Matrix:
    """The symbol's transition to the power 2 ** bit; a transition may insert rows before its own."""
    if bit:
        half = power(symbol, bit - 1)
        return times(half, half)
    rows = []
    for state in range(4):
        best, at, cost = [FAR] * 4, state, 0
        for _ in range(4):
            for _, c, to in options(symbol, at):
                best[to] = min(best[to], cost + c)
            at, cost = NEXT[at], cost + INSERT
        rows.append(tuple(best))
    return tuple(rows)


def run_matrix(symbol: int, n: int) -> Matrix:
    out, bit = ONE, 0
    while n:
        if n & 1:
            out = times(power(symbol, bit), out)
        n, bit = n >> 1, bit + 1
    return out


def run_cost(symbol: int, n: int, after: Vector) -> Vector:
    """Cost to the end before a run, from the cost after it."""
    bit = 0
    while n:
        if n & 1:
            after = apply(power(symbol, bit), after)
        n, bit = n >> 1, bit + 1
    return after


def lowered(m: Matrix) -> tuple[int, Matrix]:
    """A matrix as its smallest entry and the rest, so products of long fragments repeat and stay cached."""
    low = min(map(min, m))
    return low, tuple(tuple(FAR if x >= FAR else x - low for x in row) for row in m)


def fragment_matrix(runs: list[tuple[int, int]]) -> Matrix:
    total, out = 0, ONE
    for symbol, n in runs:
        low, step = lowered(run_matrix(symbol, n))
        more, out = lowered(times(out, step))
        total += low + more
    return tuple(tuple(FAR if x >= FAR else x + total for x in row) for row in out)


@lru_cache(maxsize=65_536)
def _row(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits of one row (inserts before it included), and the state after it."""
    before = apply(power(symbol, 0), after)
    text = ""
    while True:
        left = before[state]
        choice = [(e, to) for e, c, to in options(symbol, state) if c + after[to] == left]
        if choice and choice[0][0] == "D":
            return text + "D", choice[0][1]
        if INSERT + before[NEXT[state]] == left:
            text, state = text + "I", NEXT[state]
            continue
        return text + choice[0][0], choice[0][1]


_STRETCH = 1024  # rows whose costs are held at once


def unroll_run(symbol: int, n: int, state: int, after: Vector) -> tuple[list[str], int]:
    out = []
    while n:
        here = min(n, _STRETCH)
        costs = [run_cost(symbol, n - here, after)]
        for _ in range(here - 1):
            costs.append(apply(power(symbol, 0), costs[-1]))
        for cost in reversed(costs):
            low = min(cost)
            text, state = _row(symbol, state, tuple(x - low for x in cost))
            out.append(text)
        n -= here
    return out, state


def unroll(runs: list[tuple[int, int]], state: int, after: Vector, last: bool) -> tuple[str, int]:
    """A fragment's audit and the state it ends in. ``after``: cost from each state behind the fragment."""
    costs = [after]
    for symbol, n in reversed(runs):
        costs.append(run_cost(symbol, n, costs[-1]))
    costs.pop()
    out = []
    for symbol, n in runs:
        text, state = unroll_run(symbol, n, state, costs.pop())
        out += text
    if last:
        out.append("I" * (END[state] // INSERT))
        state = START if state == START else ASSISTANT
    return "".join(out), state


# ------------------------------------------------------------------ rows and faults

def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies: the rows after damage by the hash of conversation and turn."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")) % 20
    x = conversations.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), spaced(role).alias("role"),
                             spaced(text).alias("text"), kind.alias("kind")).where("kind != 0")
    text_now = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return x.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text_now.alias("text"),
                    F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def plain(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text, copies of rows that are repaired as they are."""
    return conversations.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
                                *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
                                F.lit(1).cast("long").alias("copies"))


def ordered(rows: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """Distinct rows in order (part, seq), with their copies, the symbol of a first occurrence and its fault, if any."""
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = written(rows.withColumn("digest", F.sha2("text", 256)), "repair-rows")
    n, size = table_size(rows)
    end = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    kind = F.when(end == "", "blank").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.left("role", F.lit(1))
    symbol = F.when(initial == "s", 1).when(initial == "u", 3).when(initial == "a", 5).otherwise(7) + (F.col("kind") == "truncated").cast("int")
    rows = rows.withColumn("kind", kind).withColumn("symbol", F.when(F.col("kind") == "blank", MUST_DELETE).otherwise(symbol).cast("int"))
    parts = max(1, -(-n // part_rows), -(-size // part_bytes))
    rows = rows.repartitionByRange(parts, "conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    return written(rows.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"), "*"), "repair-ordered")


def with_duplicates(rows: DataFrame) -> DataFrame:
    """What the automaton needs of ordered rows, without texts; those whose role and text were seen before are marked."""
    small = rows.select("part", "seq", "conv", "role", "digest", "symbol", "copies", "kind")
    first = small.groupBy("conv", "role", "digest").agg(F.min("seq").alias("first")).select("first")
    again = F.col("first").isNull() & (F.col("kind") != "blank")
    x = small.join(first, F.col("seq") == F.col("first"), "left")
    return x.select("part", "seq", "conv", F.when(again, MUST_DELETE).otherwise(F.col("symbol")).alias("symbol"), "copies",
                    F.when(again, "duplicate").otherwise(F.col("kind")).alias("kind"), F.left("role", F.lit(1)).alias("initial"))


def _streamed(df: DataFrame, fn, schema: str, batch: int = 2_000) -> DataFrame:
    """``fn(rows)`` turns an iterator of tuples into tuples, row by row; results leave in batches."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        forget()

        def rows():
            for b in (part for whole in batches for part in slices(whole)):
                yield from zip(*[b.column(i).to_pylist() for i in range(b.num_columns)])

        out = []
        for r in fn(rows()):
            out.append(r)
            if len(out) == batch:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), target)], schema=target)
        hand_back()

    return df.mapInArrow(run, schema)


def _grouped(rows, key):
    """(key, list of rows) of neighbouring rows with equal keys."""
    group, now = [], None
    for r in rows:
        k = key(r)
        if group and k != now:
            yield now, group
            group = []
        now = k
        group.append(r)
    if group:
        yield now, group


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def fragments(rows: DataFrame, kind: str) -> DataFrame:
    """A row per part and conversation: runs, matrix, counts of faults and illegal neighbours, first and last initial."""
    def collapse(source):
        now, state = None, None
        for part, seq, conv, symbol, copies, fault, initial in source:
            if state is None or (part, conv) != now:
                if state is not None:
                    yield done(now, state)
                now, state = (part, conv), {"frag": seq, "runs": [], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": initial,
                                            "tail": None}
            rest = copies - 1
            if fault == "blank":
                state["blank"] += copies
            else:
                state["duplicate"] += rest
                if fault:
                    state[fault] += 1
            for sym, n in ((symbol, 1), (MUST_DELETE, rest)):
                if n and state["runs"] and state["runs"][-1][0] == sym:
                    state["runs"][-1][1] += n
                elif n:
                    state["runs"].append([sym, n])
            if state["tail"] is not None:
                state["illegal"] += not _legal(state["tail"], initial)
            state["illegal"] += 0 if _legal(initial, initial) else rest
            state["tail"] = initial
        if state is not None:
            yield done(now, state)

    def done(now, s):
        matrix = fragment_matrix([tuple(r) for r in s["runs"]])
        return (now[0], now[1], s["frag"], [r[0] for r in s["runs"]], [r[1] for r in s["runs"]], [x for row in matrix for x in row],
                s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["head"], s["tail"])

    small = with_duplicates(rows).repartition("part").sortWithinPartitions("part", "seq")
    return written(_streamed(small, collapse, f"part int, conv {kind}, frag long, symbols array<int>, lengths array<long>, matrix array<long>, "
                             "blank long, duplicate long, truncated long, illegal long, head string, tail string"), "repair-fragments")


def remaining(frags: DataFrame, kind: str) -> DataFrame:
    """Per fragment: the cost that remains after it, whether it is the conversation's first or last, illegal seams before it; and the total."""
    def back(source):
        for conv, group in _grouped(source, lambda r: r[0]):
            after = [END]
            for _, _, m, _, _ in reversed(group):
                after.append(apply(tuple(tuple(m[4 * i: 4 * i + 4]) for i in range(4)), after[-1]))
            total = after.pop()[START]
            for i, (_, frag, _, head, _) in enumerate(group):
                seam = i > 0 and not _legal(group[i - 1][4], head)
                yield conv, frag, list(after.pop()), i == 0, i == len(group) - 1, int(seam), total if i == 0 else 0

    x = frags.select("conv", "frag", "matrix", "head", "tail").repartition("conv").sortWithinPartitions("conv", "frag")
    return _streamed(x, back, f"conv {kind}, frag long, after array<long>, first boolean, last boolean, seam long, cost long")


def audits(frags: DataFrame, rest: DataFrame, kind: str) -> DataFrame:
    """Per fragment: part, conv, frag, entry, audit."""
    def every(source):
        for part, conv, frag, symbols, lengths, after, first, last in source:
            runs = list(zip(symbols, lengths))
            low = min(after)
            got = [unroll(runs, q, tuple(x - low for x in after), last) for q in ((START,) if first else range(4))]
            yield part, conv, frag, [g[0] for g in got], [g[1] for g in got], last

    x = frags.select("part", "conv", "frag", "symbols", "lengths").join(rest.select("frag", "after", "first", "last"), "frag")
    x = x.select("part", "conv", "frag", "symbols", "lengths", "after", "first", "last")
    x = written(_streamed(x, every, f"part int, conv {kind}, frag long, audits array<string>, ends array<int>, last boolean", 200), "repair-unrolled")

    def entries(source):
        for _, group in _grouped(source, lambda r: r[0]):
            state = START
            for _, frag, ends in group:
                yield frag, state
                state = ends[state] if len(ends) > 1 else ends[0]

    chain = x.select("conv", "frag", "ends").repartition("conv").sortWithinPartitions("conv", "frag")
    entry = _streamed(chain, entries, "frag long, entry int")
    pick = F.when(F.size("audits") == 1, F.element_at("audits", 1)).otherwise(F.element_at("audits", F.col("entry") + 1))
    return written(x.join(entry, "frag").select("part", "conv", "frag", "entry", pick.alias("audit")), "repair-audits")


def repaired(rows: DataFrame, chosen: DataFrame, kind: str) -> DataFrame:
    """conv, frag, no, edit, role, text: the rows that stay or come in, in order (frag, no)."""
    def follow(source):
        audit, at, state, frag, no, conv = "", 0, START, None, 0, None

        def inserts(everything: bool):
            nonlocal at, state, no
            while at < len(audit) and audit[at] == "I":
                state = NEXT[state]
                yield conv, frag, no, "I", ROLE[state], ""
                at, no = at + 1, no + 1

        for _, seq, mark, conv_, role, text, copies, symbol, entry, plan in source:
            if mark == 0:
                yield from inserts(True)
                audit, at, state, frag, no, conv = plan, 0, entry, seq, 0, conv_
                continue
            for copy in range(copies):
                yield from inserts(False)
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = kept(symbol, state)
                    yield conv, frag, no, "K", role, text
                elif edit == "R":
                    state = NEXT[state]
                    yield conv, frag, no, "R", ROLE[state], text
                no += 1
        yield from inserts(True)

    null = lambda t: F.lit(None).cast(t)
    a = rows.select("part", "seq", F.lit(1).alias("mark"), "conv", "role", "text", "copies", "symbol", null("int").alias("entry"),
                    null("string").alias("audit"))
    b = chosen.select("part", F.col("frag").alias("seq"), F.lit(0).alias("mark"), "conv", null("string").alias("role"), null("string").alias("text"),
                      null("long").alias("copies"), null("int").alias("symbol"), "entry", "audit")
    x = a.unionByName(b).repartition("part").sortWithinPartitions("part", "seq", "mark")
    return written(_streamed(x, follow, f"conv {kind}, frag long, no long, edit string, role string, text string", 500), "repair-repaired")


def hashes(kept_rows: DataFrame, chosen: DataFrame, kind: str) -> DataFrame:
    """conv, audit, sha: the whole audit and the hash of ``role:text`` lines joined by newlines, streamed."""
    def digest(source):
        started, now, audit, sha, begun = False, None, [], None, False
        for conv, _, _, role, text, plan in source:
            if not started or conv != now:
                if started:
                    yield now, "".join(audit), sha.hexdigest()
                started, now, audit, sha, begun = True, conv, [], hashlib.sha256(), False
            if plan is not None:
                audit.append(plan)
                continue
            sha.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
        if started:
            yield now, "".join(audit), sha.hexdigest()

    null = F.lit(None).cast("string")
    a = kept_rows.select("conv", "frag", "no", "role", "text", null.alias("audit"))
    b = chosen.select("conv", "frag", F.lit(-1).cast("long").alias("no"), null.alias("role"), null.alias("text"), "audit")
    x = a.unionByName(b).repartition("conv").sortWithinPartitions("conv", "frag", "no")
    return _streamed(x, digest, f"conv {kind}, audit string, sha string", 500)


@dataclass(frozen=True)
class Repair:
    """``rows``: the repaired rows (conv, frag, no, edit, role, text); ``summary``: a row per conversation that has rows."""

    rows: DataFrame
    summary: DataFrame


def repair(rows: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> Repair:
    """Repair conversations given as conv, turn, role, text, copies (see ``damage`` and ``plain``)."""
    kind = rows.schema["conv"].dataType.simpleString()
    rows = ordered(rows, part_rows, part_bytes)
    frags = fragments(rows, kind)
    rest = written(remaining(frags, kind), "repair-remaining")
    chosen = audits(frags, rest, kind)
    out = repaired(rows, chosen, kind)
    turns = rows.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counts = frags.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
    seams = rest.groupBy("conv").agg(F.sum("seam").alias("seam"), F.sum("cost").alias("cost"))
    x = counts
    for n, other in enumerate((seams, gaps, hashes(out, chosen, kind))):
        other = other.withColumnRenamed("conv", f"c{n}")
        x = x.join(other, F.col("conv").eqNullSafe(F.col(f"c{n}")), "left")
    summary = x.select("conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated",
                       (F.col("illegal") + F.col("seam")).alias("illegal"), "cost", "audit", F.col("sha").alias("repaired_sha256"))
    return Repair(out, summary)


def op13(conversations: DataFrame) -> DataFrame:
    """Damage, repair, and a row per original conversation."""
    found = repair(damage(conversations)).summary
    ids = conversations.select(F.col("conv_id")).distinct()
    x = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return x.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _oracle() -> str:
    """Plain dynamic programming from the last row to the first, whole strings carried along; no runs, no matrices."""
    def struct(cost, audit, lines):
        return f"{{'c': {cost}, 'a': {audit}, 'r': {lines}}}"

    def added(v, cost, char, line=None):
        return struct(f"{v}.c + {cost}", f"'{char}' || {v}.a", f"list_prepend({line}, {v}.r)" if line else f"{v}.r")

    steps = []
    keep = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
    for q in range(4):
        opts = [added(f"p.v{q}", DELETE, "D")]
        for initial, moves in keep.items():
            if q in moves:
                opts.append(f"CASE WHEN NOT gone AND initial = '{initial}' THEN {added(f'p.v{moves[q]}', 'late', 'K', 'line')} END")
        role = ROLE[NEXT[q]]
        opts.append(f"CASE WHEN NOT gone THEN {added(f'p.v{NEXT[q]}', f'{RETYPE} + late', 'R', chr(39) + role + ':' + chr(39) + ' || text')} END")
        steps.append(f"list_min(list_filter([{', '.join(opts)}], lambda o: o IS NOT NULL)) AS b{q}")
    final = []
    for q in range(4):
        opts, at, lines, n = [f"b{q}"], q, [], 0
        for _ in range(3):
            lines, n, at = lines + [f"'{ROLE[NEXT[at]]}:'"], n + 1, NEXT[at]
            opts.append(struct(f"b{at}.c + {INSERT * n}", f"'{'I' * n}' || b{at}.a", f"[{', '.join(lines)}] || b{at}.r"))
        final.append(f"list_min([{', '.join(opts)}]) AS v{q}")
    none = "[]::VARCHAR[]"
    ends = [struct("0::BIGINT", "''", none), struct(2 * INSERT, "'II'", "['user:', 'assistant:']"), struct(INSERT, "'I'", "['assistant:']"),
            struct("0::BIGINT", "''", none)]
    kind = "STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
    return rf"""
WITH RECURSIVE {CRC_TABLE},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, crc_table),
g AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM k WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again,
  right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last, left(role, 1) AS initial,
  count(*) OVER (PARTITION BY conv_id) AS n FROM g),
f AS (SELECT *, last = '' AS blank, last <> '' AND again > 1 AS duplicate, last <> '' AND again = 1 AND last NOT IN ('.', '!', '?') AS truncated FROM o),
x AS (SELECT *, blank OR duplicate AS gone, CASE WHEN truncated THEN {TRUNCATED} ELSE 0 END AS late, role || ':' || text AS line,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM f),
w AS (
  SELECT conv_id, max(n) AS i, {", ".join(f"{e}::{kind} AS v{q}" for q, e in enumerate(ends))} FROM x GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, {", ".join(final)} FROM (
    SELECT p.conv_id, p.i, {", ".join(steps)} FROM w p JOIN x ON x.conv_id IS NOT DISTINCT FROM p.conv_id AND x.i = p.i)),
s AS (SELECT conv_id, v0 FROM w WHERE i = 0),
c AS (SELECT conv_id, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
  count(*) FILTER (previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM x GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.c, 0)::BIGINT AS cost, coalesce(v0.a, '') AS audit,
  sha256(coalesce(array_to_string(v0.r, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


ORACLE = _oracle()
