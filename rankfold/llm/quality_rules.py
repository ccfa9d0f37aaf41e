"""Rule bitmask ledger: every rule is evaluated once; policies and ablations are bit arithmetic.

``measure`` reads each whole text once and returns counts. ``ledger`` turns
them into one bit per failed rule. A policy is a named set of rules, so a new
policy version, or the effect of leaving a rule out, never reads a text again.

Null and empty texts have no words: all counts are 0 and the ``short`` bit is
set. A null doc_id is passed through. Repeated rows give repeated rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rankfold.llm.common import SPACES, map_batches, text_rows

SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower")

#: Rule name -> failure condition over the measures. The position is the bit.
RULES = {
    "short": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "n_dup_lines > 4 and 100 * n_dup_lines > 50 * n_lines",
    "shouting": "n_upper > n_lower",
    "long_words": "word_chars > 25 * n_words",
}

#: Policy version -> rules that reject.
POLICIES = {
    "base": ("short", "repeated_windows"),
    "v1": ("short", "repeated_windows", "symbols"),
    "v2": tuple(RULES),
}


def repeated_window_words(words: list, width: int = 3) -> int:
    """Words lying in a window of ``width`` words that is found twice or more."""
    n = len(words)
    if n < width + 1:
        return 0
    first: dict = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    key = ids[: n - width + 1]
    for j in range(1, width):
        _, key = np.unique(key, return_inverse=True)
        key = key * n + ids[j: n - width + 1 + j]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    hit = counts[inverse] > 1
    covered = np.zeros(n, bool)
    for j in range(width):
        covered[j: n - width + 1 + j] |= hit
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``MEASURES``."""
    if not text:
        return (0,) * len(MEASURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six separators
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LOWER)),
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and its measures."""

    def run(_, cols):
        rows = [measure_text(t) for t in cols[text_col]]
        return {id_col: cols[id_col]} | {m: [r[i] for r in rows] for i, m in enumerate(MEASURES)}

    ids = docs.select(id_col).schema[0].dataType.simpleString()
    return map_batches(text_rows(docs, id_col, text_col), run,
                       f"`{id_col}` {ids}, " + ", ".join(f"{m} long" for m in MEASURES))


def failures(rules: dict[str, str] = RULES) -> Column:
    """The ledger entry: bit i is set when rule i fails."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, cond in enumerate(rules.values())]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def mask(names, rules: dict[str, str] = RULES) -> int:
    order = list(rules)
    return sum(1 << order.index(n) for n in names)


def ledger(docs: DataFrame, rules: dict[str, str] = RULES, id_col: str = "doc_id") -> DataFrame:
    """Measures plus ``failed`` (bitmask), each rule evaluated once per document."""
    return measure(docs, id_col).withColumn("failed", failures(rules))


def passes(policy: str, policies=POLICIES, rules: dict[str, str] = RULES) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(policies[policy], rules))) == 0


def ablations(entries: DataFrame, policy: str, policies=POLICIES, rules: dict[str, str] = RULES) -> DataFrame:
    """For each rule of a policy: documents failing it, failing only it, and kept without it.

    The ledger is first grouped to its distinct bitmasks (at most 2^rules rows),
    so any number of ablations costs one pass over one column.
    """
    m = mask(policies[policy], rules)
    order = list(rules)
    groups = entries.groupBy(F.col("failed").bitwiseAND(F.lit(m)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << order.index(n)).cast("long").alias("bit"))
                               for n in policies[policy]])).alias("r")
    x = groups.select("bits", "n", rule).select("bits", "n", "r.rule", "r.bit")
    left = F.col("bits").bitwiseAND(F.lit(m).bitwiseXOR(F.col("bit")))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return x.groupBy("rule").agg(count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
                                 count(F.col("bits") == F.col("bit")).alias("failing_only_this"),
                                 count(left == 0).alias("kept_without"))


def op1(docs: DataFrame) -> DataFrame:
    base = F.col("failed").bitwiseAND(F.lit(mask(POLICIES["base"]))) != 0
    return ledger(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               base.alias("base_failed"), passes("v2").alias("kept"), "failed")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
tok AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT r, i, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p AS k FROM tok
        WINDOW p AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win WHERE k IS NOT NULL),
cov AS (SELECT r, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS o) WHERE c > 1 GROUP BY r),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(cov.n, 0) AS n_repeat_words, len(ls) AS n_lines,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower
      FROM w LEFT JOIN cov USING (r)),
f AS (SELECT *, (n_words < 50)::INT::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
        + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (n_dup_lines > 4 AND 100 * n_dup_lines > 50 * n_lines)::INT
        + 16 * (n_upper > n_lower)::INT + 32 * (word_chars > 25 * n_words)::INT AS failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (failed & 3) <> 0 AS base_failed,
  failed = 0 AS kept, failed::BIGINT AS failed FROM f
"""
