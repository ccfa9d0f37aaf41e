import random
import re

import duckdb
import pandas as pd
import pytest

from rankfold.llm import quotes

SCHEMA = "conv_id long, turn long, role string, text string, n int, hash string, thread string, up int, c1 long, first long"
MARKS = re.compile(r"^(?:[ \t]*>)+")


def norm(t):
    return re.sub(r"[ \t\n\x0b\x0c\r]+", " ", t.lower()).strip(" ")


def split(text):
    """(own lines, passages as (level, lines)) of a text."""
    own, found, last = [], [], 0
    for line in (text or "").split("\n"):
        marks = MARKS.match(line)
        level = marks[0].count(">") if marks else 0
        if not level:
            own.append(line)
        elif level == last:
            found[-1][1].append(line[marks.end():])
        else:
            found.append((level, [line[marks.end():]]))
        last = level
    return own, found


def brute(rows):
    said = []
    for conv, turn, _, text in rows:
        if conv is not None and turn is not None and text is not None:
            own = split(text)[0]
            said.append((conv, turn, [x for x in map(norm, own) if x], norm(" ".join(own))))

    def holds(lines, u):
        joined, kept = norm(" ".join(lines)), [x for x in map(norm, lines) if x]
        row = any(u[2][i:i + len(kept)] == kept for i in range(len(u[2]) - len(kept) + 1))
        return bool(joined) and (joined == u[3] or joined in u[2] or row)

    out, up = [], {}
    for conv, turn, role, text in rows:
        own, found = split(text)
        n = reply = other = None
        n, replies, others = 0, [], []
        for level, lines in found:
            first = min((u[1] for u in said if u[0] == conv and turn is not None and u[1] < turn and holds(lines, u)), default=None)
            elsewhere = min((u[0] for u in said if conv is not None and u[0] != conv and holds(lines, u)), default=None)
            n += first is not None or elsewhere is not None
            if first is None and elsewhere is not None:
                others.append(elsewhere)
            if level == 1 and first is not None:
                replies.append(first)
        reply, other = max(replies, default=None), min(others, default=None)
        if reply is not None:
            up[conv, turn] = max(up.get((conv, turn), reply), reply)
        out.append([conv, turn, role, len(found), n, max((lv for lv, _ in found), default=0), reply, other])
    for r in out:
        at = r[1]
        while (r[0], at) in up:
            at = up[r[0], at]
        r.append(at)
    low = lambda x: (x is not None, x or 0)
    for r in out:
        r.append(1 + sum(o[0] == r[0] and (low(o[8]), low(o[1])) < (low(r[8]), low(r[1])) for o in out))
    return sorted(map(tuple, out), key=str)


def got(spark, rows):
    m = spark.createDataFrame([(*r, 1, "x", "y", 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    cols = ("conv_id", "turn", "role", "n_passages", "n_linked", "max_level", "reply_to_turn", "quoted_conv", "thread", "thread_place")
    return sorted((tuple(r[c] for c in cols) for r in quotes.link(m).collect()), key=str)


LINES = ["Hi all,", "see  below.", "Thanks!", "the plan\tis", "to go", "", "Regards", "Yes."]


def threads(seed, convs=5, turns=7):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        told = []
        for t in range(turns):
            body = [rng.choice(LINES) for _ in range(rng.randrange(1, 6))]
            lines = list(body)
            pool = told or [r[3].split("\n") for r in rows if r[3]]
            if pool and rng.random() < 0.8:
                old = rng.choice(pool)
                i = rng.randrange(len(old))
                part = old[i: i + rng.randrange(1, 4)]
                style = rng.random()
                quoted = [f"> {x}" for x in part] if style < 0.7 else ["> " + " ".join(part).upper()]
                lines = quoted + lines if rng.random() < 0.5 else lines + quoted
            told.append(lines)
            rows.append((c if rng.random() < 0.95 else None, t if rng.random() < 0.95 else None, "user", "\n".join(lines)))
    return rows + [(0, 99, "user", None), (0, 99, "user", ""), rows[0], rows[0]]


@pytest.mark.parametrize("seed", range(4))
def test_links_and_threads_by_brute_force(spark, seed):
    rows = threads(seed)
    assert got(spark, rows) == brute(rows)


def test_sql_by_brute_force():
    rows = threads(11)
    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    con.execute("CREATE VIEW conversations AS SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, role, text FROM given")
    rel = con.sql(quotes.ORACLE)
    at = [rel.columns.index(c) for c in ("conv_id", "turn", "role", "n_passages", "n_linked", "max_level", "reply_to_turn", "quoted_conv", "thread",
                                         "thread_place")]
    assert sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str) == brute(rows)


def test_a_later_turn_of_the_own_conversation_hides_no_other(spark):
    rows = [(4, 0, "user", "> shared line"), (4, 1, "user", "shared line"), (9, 0, "user", "shared line")]
    first = next(r for r in got(spark, rows) if r[:2] == (4, 0))
    assert first[4] == 1 and first[7] == 9


def test_two_lines_of_five_link(spark):
    rows = [(1, 0, "user", "Hi,\none two\nthree four\nfive\nBye"), (1, 1, "user", "> three four\n> five\nyes"), (1, 2, "user", "> one two\n> five\nno")]
    by = {r[1]: r for r in got(spark, rows)}
    assert by[1][4] == 1 and by[1][6] == 0 and by[2][4] == 0 and by[2][6] is None


def test_deep_and_wide_threads(spark):
    deep = [(1, t, "user", f"line {t}." + (f"\n> line {t - 1}." if t else "")) for t in range(40)]
    wide = [(2, t, "user", f"answer {t}.\n> question" if t else "question") for t in range(40)]
    assert got(spark, deep + wide) == brute(deep + wide)
