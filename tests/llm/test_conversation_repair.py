import hashlib
import itertools
import random
import re
import zlib

import pytest

from rankfold.llm import conversation_repair as C

PATTERN = re.compile(r"(s?(ua)+)?")
ROWS = "conv_id long, turn long, role string, text string, conv string, copies int, part string"
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """rows of one conversation in order -> (role, text, fault)."""
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def exhaustive(rows):
    """Every edit list with up to two inserts in each gap: the smallest (cost, audit), and its lines."""
    gaps = [[("I" * len(g), 3 * len(g), [("user" if c == "u" else "assistant", "") for c in g]) for g in gs]
            for gs in [("", "u", "a", "ua", "au")] * (len(rows) + 1)]
    moves = []
    for role, text, fault in rows:
        late = 3 * (fault == "truncated")
        own = [("D", 4, [])]
        if fault not in ("blank", "duplicate"):
            own += [("K", late, [(role, text)])] + [("R", 3 + late, [(r, text)]) for r in ("user", "assistant")]
        moves.append(own)
    best = None
    order = [x for pair in itertools.zip_longest(gaps, moves) for x in pair if x is not None]
    for picked in itertools.product(*order):
        lines = [line for _, _, ls in picked for line in ls]
        if any(not r for r, _ in lines) or not PATTERN.fullmatch("".join(r[0] for r, _ in lines)):
            continue
        found = (sum(c for _, c, _ in picked), "".join(e for e, _, _ in picked), lines)
        if best is None or found[:2] < best[:2]:
            best = found
    return best


def stepwise(rows):
    """The same by plain dynamic programming over single rows, for longer conversations."""
    step = {0: 2, 1: 2, 2: 3, 3: 2}
    value = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for role, text, fault in reversed(rows):
        late, base = 3 * (fault == "truncated"), {}
        for q in range(4):
            opts = [(value[q][0] + 4, "D" + value[q][1])]
            if fault not in ("blank", "duplicate"):
                to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(role[:1], {}).get(q)
                if to is not None:
                    opts.append((value[to][0] + late, "K" + value[to][1]))
                opts.append((value[step[q]][0] + 3 + late, "R" + value[step[q]][1]))
            base[q] = min(opts)
        value = {q: min((base[p][0] + 3 * n, "I" * n + base[p][1]) for n, p in ((0, q), (1, step[q]), (2, step[step[q]]))) for q in range(4)}
    return value[0]


def expected(rows, solve=exhaustive):
    by = {}
    for r in rows:
        by.setdefault(r[0], [])
    for r in damaged(rows):
        by[r[0]].append(r)
    out = {}
    for conv, rs in by.items():
        rs.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        fs = faults(rs)
        turns = {r[1] for r in rs} - {None}
        got = solve(fs)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in got[2]).encode()).hexdigest() if len(got) > 2 else None
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(fs, fs[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[sum(f == k for _, _, f in fs) for k in ("blank", "duplicate", "truncated")],
                     illegal, got[0], got[1], sha)
    return out


def summary(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def made(spark, rows):
    return spark.createDataFrame([(*r, "c", 5, "p") for r in rows], ROWS)


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", None, "User"]
    texts = ["Yes.", "No", "Why?", "", " \t", None, "Stop!", "so on \n", "…"]
    return [(c, rng.choice([t, t, None, 1]), rng.choice(roles), rng.choice(texts)) for c in range(convs) for t in range(rng.randrange(1, most + 1))]


@pytest.mark.parametrize("part_rows", [C.PART_ROWS, 4])
def test_every_edit_list(spark, part_rows, monkeypatch):
    monkeypatch.setattr(C.repair, "__defaults__", (part_rows, C.PART_BYTES))
    rows = some_rows(1, 40, 3) + [(None, 0, "user", "Hm."), (None, 1, "user", "Hm."), (99, None, "system", "Only.")]
    rows = [r for r in rows if len([x for x in damaged(rows) if x[0] == r[0]]) <= 4]
    assert summary(C.op13(made(spark, rows))) == expected(rows)


@pytest.mark.parametrize("part_rows", [C.PART_ROWS, 5])
def test_long_conversations(spark, part_rows, monkeypatch):
    monkeypatch.setattr(C.repair, "__defaults__", (part_rows, C.PART_BYTES))
    rows = some_rows(2, 12, 40) + [(50, t, "user", f"Line {t}.") for t in range(3000)] + [(51, 0, "user", "x.")] * 2000
    got = summary(C.op13(made(spark, rows)))
    want = expected(rows, stepwise)
    assert {c: v[:-1] for c, v in got.items()} == {c: v[:-1] for c, v in want.items()}


def test_repaired_rows_match_the_pattern_and_the_hash(spark):
    rows = some_rows(4, 30, 12)
    found = C.repair(C.damage(made(spark, rows)), part_rows=3)
    lines = {}
    for r in sorted(found.rows.collect(), key=lambda r: (r.frag, r.no)):
        lines.setdefault(r.conv, []).append((r.role, r.text))
    for r in found.summary.collect():
        own = lines.get(r.conv, [])
        assert PATTERN.fullmatch("".join(role[0] for role, _ in own))
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest()


def test_undamaged_conversation_stays(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "assistant", "Yes!")]
    r, = C.repair(C.plain(made(spark, rows))).summary.collect()
    assert (r.cost, r.audit, r.illegal) == (0, "KKK", 0)


def test_powers_equal_single_steps():
    for symbol in range(9):
        v = w = C.END
        for n in range(1, 40):
            v = C.apply(C.power(symbol, 0), v)
            assert C.run_cost(symbol, n, w) == v
            m = C.run_matrix(symbol, n)
            assert C.apply(m, w) == v


def test_very_long_runs_unroll_in_stretches():
    audit, state = C.unroll([(4, 5000), (0, 3000)], C.START, C.END, True)  # truncated user rows, then blank ones
    rows = [("user", f"t{i}", "truncated") for i in range(5000)] + [("user", "", "blank")] * 3000
    assert audit == stepwise(rows)[1] and state in (C.START, C.ASSISTANT)


def test_empty_table_and_conversations_without_rows(spark):
    assert C.op13(made(spark, [])).count() == 0
    gone = next((c, 0, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert summary(C.op13(made(spark, [gone]))) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
