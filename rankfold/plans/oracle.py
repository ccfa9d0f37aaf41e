"""DuckDB SQL for every catalogue entry (the correctness oracle).

Written independently of the Spark plans from the pinned formulas: same
token rule, BM25 formula, rounding and tie-breaks, brute force where that is
simplest (theta joins, all pairs) since the oracle runs on small data.
"""

from __future__ import annotations

# The 33 English stop words, stated apart from the engine's own list.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()

_STOPS = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_HEX15 = "1152921504606846976.0"


def tok(expr: str) -> str:
    return (f"list_filter(regexp_extract_all(lower(coalesce({expr}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
            f"lambda t: NOT list_contains({_STOPS}, t))")


def md5_long(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


INDEX = f"""
toks AS (SELECT doc_id, {tok('text')} AS toks FROM documents),
postings AS (
  SELECT term, doc_id, dl, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, len(toks)::INTEGER AS dl, unnest(toks) AS term FROM toks)
  GROUP BY term, doc_id, dl),
term_stats AS (SELECT term, count(*)::BIGINT AS df FROM postings GROUP BY term),
cstats AS (
  SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
         (SELECT coalesce(sum(tf), 0) FROM postings)::BIGINT AS total_len)"""


def bm25(name: str, k: int, okapi: bool = False) -> str:
    factor = " * 2.5" if okapi else ""
    return f"""
{name}_qt AS (
  SELECT query_id, term, count(*)::BIGINT AS qtf
  FROM (SELECT item_id AS query_id, unnest({tok('text')}) AS term FROM benchmark)
  GROUP BY query_id, term),
{name}_sc AS (
  SELECT q.query_id, p.doc_id,
         round(sum(q.qtf::DOUBLE
                   * ln(1.0 + (c.n_docs::DOUBLE - s.df::DOUBLE + 0.5) / (s.df::DOUBLE + 0.5))
                   * p.tf::DOUBLE
                   / (p.tf::DOUBLE + 1.5 * (0.25 + 0.75 * p.dl::DOUBLE
                                           / (c.total_len::DOUBLE / c.n_docs::DOUBLE))){factor}), 6) AS score
  FROM {name}_qt q JOIN term_stats s USING (term) JOIN postings p USING (term) CROSS JOIN cstats c
  GROUP BY q.query_id, p.doc_id),
{name} AS (
  SELECT query_id, doc_id, score, rnk FROM (
    SELECT query_id, doc_id, score,
           (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC))::INTEGER AS rnk
    FROM {name}_sc) WHERE rnk <= {k})"""


QRELS = """
qrels AS (
  SELECT DISTINCT b.item_id AS query_id, d.doc_id
  FROM benchmark b JOIN documents d ON contains(d.text, b.text)
  WHERE b.text IS NOT NULL AND length(b.text) > 0)"""

JUDGED = QRELS + """,
judged AS (
  SELECT q.item_id AS query_id, q.text AS query, d.doc_id, d.text,
         (count(*) OVER (PARTITION BY q.item_id))::BIGINT AS query_docs
  FROM benchmark q JOIN qrels r ON r.query_id = q.item_id JOIN documents d ON d.doc_id = r.doc_id)"""


def curve(name: str, run: str, rank_col: str = "rnk", max_num: int = 100) -> str:
    """Curve against containment qrels (needs the QRELS cte)."""
    return f"""
{name}_nrel AS (SELECT query_id, count(*)::BIGINT AS n_rel FROM qrels GROUP BY query_id),
{name}_flag AS (
  SELECT r.query_id, r.{rank_col} AS rk, (j.doc_id IS NOT NULL) AS relevant
  FROM {run} r LEFT JOIN qrels j ON j.query_id = r.query_id AND j.doc_id = r.doc_id
  WHERE r.{rank_col} <= {max_num}),
{_curve_tail(name)}"""


def _curve_tail(name: str) -> str:
    return f"""{name}_cum AS (
  SELECT query_id, rk,
         (sum(relevant::BIGINT) OVER (PARTITION BY query_id ORDER BY rk
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS tp
  FROM {name}_flag),
{name} AS (
  SELECT c.query_id, c.rk::INTEGER AS top_k, c.tp, n.n_rel,
         round(c.tp::DOUBLE / c.rk::DOUBLE, 9) AS precision,
         round(CASE WHEN n.n_rel <> 0 THEN c.tp::DOUBLE / n.n_rel::DOUBLE ELSE 0.0 END, 9) AS recall,
         round(CASE WHEN c.rk + n.n_rel <> 0 THEN (2 * c.tp)::DOUBLE / (c.rk + n.n_rel)::DOUBLE
                    ELSE 0.0 END, 9) AS f1
  FROM {name}_cum c JOIN {name}_nrel n USING (query_id))"""


def label_curve(name: str, run: str, max_num: int = 100) -> str:
    return f"""
{name}_nrel AS (
  SELECT q.vec_id AS query_id,
         (SELECT count(*) FROM embeddings e WHERE e.label = q.label AND e.vec_id <> q.vec_id)::BIGINT AS n_rel
  FROM embeddings q),
{name}_flag AS (
  SELECT r.query_id, r.rnk AS rk, (qe.label = de.label) AS relevant
  FROM {run} r JOIN embeddings qe ON qe.vec_id = r.query_id JOIN embeddings de ON de.vec_id = r.doc_id
  WHERE r.rnk <= {max_num}),
{_curve_tail(name)}"""


def mean(name: str, src: str) -> str:
    return f"""
{name} AS (
  SELECT top_k, count(*)::BIGINT AS n_queries, round(avg(precision), 9) AS precision,
         round(avg(recall), 9) AS recall, round(avg(f1), 9) AS f1
  FROM {src} GROUP BY top_k)"""


def _sq_l2(a: str, b: str) -> str:
    return (f"list_sum(list_transform(range(1, len({a}) + 1), "
            f"lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) * ({a}[i]::DOUBLE - {b}[i]::DOUBLE)))")


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))"


def vec_run(name: str, k: int, metric: str = "l2") -> str:
    if metric == "l2":
        score, order = f"round({_sq_l2('q.embedding', 'd.embedding')}, 6)", "score ASC"
    elif metric == "dist":
        score, order = f"round(sqrt({_sq_l2('q.embedding', 'd.embedding')}), 6)", "score ASC"
    else:
        num = _dot("q.embedding", "d.embedding")
        den = f"(sqrt({_dot('q.embedding', 'q.embedding')}) * sqrt({_dot('d.embedding', 'd.embedding')}))"
        score, order = f"round(CASE WHEN {den} > 0 THEN {num} / {den} ELSE 0.0 END, 6)", "score DESC"
    return f"""
{name}_all AS (
  SELECT q.vec_id AS query_id, d.vec_id AS doc_id, {score} AS score
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id),
{name} AS (
  SELECT query_id, doc_id, score, rnk FROM (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY {order}, doc_id ASC))::INTEGER AS rnk
    FROM {name}_all) WHERE rnk <= {k})"""


def hash_cells(name: str, table: str, id_col: str, text_col: str) -> str:
    return f"""
{name}_h AS (
  SELECT id, {md5_long('t')} AS h
  FROM (SELECT {id_col} AS id, unnest({tok(text_col)}) AS t FROM {table})),
{name}_c AS (
  SELECT id, (h % 64)::INTEGER AS dim,
         sum(CASE WHEN (h // 64) % 2 = 0 THEN 1.0 ELSE -1.0 END)::DOUBLE AS v
  FROM {name}_h GROUP BY id, dim),
{name}_n AS (SELECT id, sqrt(sum(v * v)) AS nrm FROM {name}_c GROUP BY id)"""


def hash_dense(name: str, table: str, id_col: str, text_col: str) -> str:
    return hash_cells(name, table, id_col, text_col) + f""",
{name} AS (
  SELECT i.id, list(CASE WHEN n.nrm > 0 THEN coalesce(c.v, 0.0) / n.nrm ELSE 0.0 END ORDER BY g.dim) AS emb
  FROM (SELECT {id_col} AS id FROM {table}) i CROSS JOIN range(64) g(dim)
  LEFT JOIN {name}_c c ON c.id = i.id AND c.dim = g.dim
  LEFT JOIN {name}_n n ON n.id = i.id
  GROUP BY i.id)"""


def hash_run(name: str, k: int) -> str:
    return (hash_dense(f"{name}_hd", "documents", "doc_id", "text") + ","
            + hash_dense(f"{name}_hq", "benchmark", "item_id", "text") + f""",
{name}_all AS (
  SELECT q.id AS query_id, d.id AS doc_id, round({_sq_l2('q.emb', 'd.emb')}, 6) AS score
  FROM {name}_hq q CROSS JOIN {name}_hd d),
{name} AS (
  SELECT query_id, doc_id, score, rnk FROM (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score ASC, doc_id ASC))::INTEGER AS rnk
    FROM {name}_all) WHERE rnk <= {k})""")


def rrf2(name: str, a: str, b: str) -> str:
    return f"""
{name}_u AS (
  SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.doc_id, b.doc_id) AS doc_id,
         (a.rnk - 1)::DOUBLE AS rank1, (b.rnk - 1)::DOUBLE AS rank2
  FROM {a} a FULL OUTER JOIN {b} b ON a.query_id = b.query_id AND a.doc_id = b.doc_id),
{name}_f AS (
  SELECT query_id, doc_id, coalesce(rank1, n) AS rank1, coalesce(rank2, n) AS rank2 FROM (
    SELECT *, (count(*) OVER (PARTITION BY query_id))::DOUBLE AS n FROM {name}_u)),
{name} AS (
  SELECT query_id, doc_id, rank1, rank2, rerank,
         (row_number() OVER (PARTITION BY query_id ORDER BY rerank DESC, doc_id ASC))::INTEGER AS rnk
  FROM (SELECT *, round(1.0 / (60.0 + rank1) + 1.0 / (60.0 + rank2), 9) AS rerank FROM {name}_f))"""


def overlap(name: str, run: str) -> str:
    return f"""
{name}_p AS (
  SELECT r.query_id, r.doc_id, r.score, r.rnk,
         list_distinct({tok('b.text')}) AS qt, list_distinct({tok('d.text')}) AS dt
  FROM {run} r JOIN benchmark b ON b.item_id = r.query_id JOIN documents d ON d.doc_id = r.doc_id),
{name} AS (
  SELECT query_id, doc_id, score, rnk, rerank,
         (row_number() OVER (PARTITION BY query_id ORDER BY rerank DESC, doc_id ASC))::INTEGER AS new_rnk
  FROM (SELECT query_id, doc_id, score, rnk,
               round(CASE WHEN len(list_distinct(list_concat(qt, dt))) > 0
                          THEN len(list_intersect(qt, dt))::DOUBLE / len(list_distinct(list_concat(qt, dt)))::DOUBLE
                          ELSE 0.0 END, 9) AS rerank
        FROM {name}_p))"""


SPLIT = JUDGED + """,
cnt AS (SELECT query_id, count(*) AS n FROM judged GROUP BY query_id),
test_ids AS (SELECT query_id FROM cnt ORDER BY n DESC, query_id ASC LIMIT 5),
train AS (SELECT * FROM judged WHERE query_id NOT IN (SELECT query_id FROM test_ids)),
test AS (SELECT * FROM judged WHERE query_id IN (SELECT query_id FROM test_ids))"""

NEGATIVES = SPLIT + f""",
pool AS (SELECT doc_id, min(text) AS text FROM train GROUP BY doc_id),
ring AS (
  SELECT doc_id, row_number() OVER (ORDER BY h, doc_id) - 1 AS pos
  FROM (SELECT doc_id, {md5_long("'42|d|' || doc_id::VARCHAR")} AS h FROM pool)),
psize AS (SELECT count(*) AS p FROM pool),
perq AS (SELECT query_id, first(query) AS query, count(DISTINCT doc_id) AS n_pos FROM train GROUP BY query_id),
steps AS (
  SELECT query_id, query, n_pos, j, (start + j) % p AS pos FROM (
    SELECT query_id, query, n_pos, p, {md5_long("'42|q|' || query_id::VARCHAR")} % p AS start,
           unnest(range(0, least(2 * n_pos, p))) AS j
    FROM perq CROSS JOIN psize)),
cand AS (
  SELECT s.query_id, r.doc_id, s.query, s.j, s.n_pos
  FROM steps s JOIN ring r USING (pos)
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.query_id = s.query_id AND t.doc_id = r.doc_id)),
negs AS (
  SELECT c.query_id, c.doc_id, c.query, p.text, 0 AS label FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY j) AS rr FROM cand) c
  JOIN pool p USING (doc_id) WHERE rr <= n_pos),
pairs AS (
  SELECT DISTINCT query_id, doc_id, query, text, 1 AS label FROM train
  UNION ALL SELECT query_id, doc_id, query, text, label FROM negs)"""

GROUPS = NEGATIVES + f""",
hit_ids AS (
  SELECT DISTINCT query_id FROM pairs
  WHERE {md5_long("'42|' || query_id::VARCHAR || '|' || doc_id::VARCHAR || '|' || label::VARCHAR")}::DOUBLE
        / {_HEX15} < 0.25)"""

EXACT_GROUPS = NEGATIVES + f""",
hashed AS (SELECT query_id, row_number() OVER (ORDER BY {md5_long("'42|' || query_id::VARCHAR || '|' || doc_id::VARCHAR || '|' || label::VARCHAR")},
                  query_id, doc_id, label) AS pos FROM pairs),
hit_ids AS (SELECT DISTINCT query_id FROM hashed WHERE pos <= (SELECT floor(count(*) * 0.25) FROM pairs)),
parts AS (SELECT query_id, doc_id, label, CASE WHEN query_id IN (SELECT query_id FROM hit_ids)
                                               THEN 'train' ELSE 'validation' END AS part FROM pairs)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


BM100 = bm25("lex", 100)
HASH100 = hash_run("vec", 100)
PAIR_RUN = overlap("ov", "lex")

SCORE_REGRESSION = _with(INDEX, BM100, PAIR_RUN) + """,
g AS (SELECT query_id, regr_count(rerank, score)::BIGINT AS n, regr_slope(rerank, score) AS slope,
             regr_intercept(rerank, score) AS intercept, corr(rerank, score) AS r
      FROM ov GROUP BY query_id)
SELECT query_id, n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(r, 6) AS r,
       round(CASE WHEN n > 2 AND abs(r) < 1 THEN r * sqrt((n - 2)::DOUBLE / (1.0 - r * r)) END, 6) AS t
FROM g"""

ORACLE_SQL = {
    "tokenize_terms": f"""
SELECT doc_id, len({tok('text')})::BIGINT AS n_terms, len(list_distinct({tok('text')}))::BIGINT AS n_distinct
FROM documents""",
    "corpus_stats": _with(INDEX) + """
SELECT n_docs, total_len, total_len::DOUBLE / n_docs::DOUBLE AS avgdl FROM cstats""",
    "doc_lengths": f"SELECT doc_id, len({tok('text')})::INTEGER AS dl FROM documents",
    "term_doc_freq": _with(INDEX) + "\nSELECT term, df FROM term_stats",
    "postings_tf": _with(INDEX) + "\nSELECT term, doc_id, dl, tf FROM postings",
    "bm25_top10": _with(INDEX, bm25("run", 10)) + "\nSELECT * FROM run",
    "bm25_impacts_top10": _with(INDEX, bm25("run", 10)) + "\nSELECT * FROM run",
    "bm25_okapi_top10": _with(INDEX, bm25("run", 10, okapi=True)) + "\nSELECT * FROM run",
    "bm25_top100": _with(INDEX, bm25("run", 100)) + "\nSELECT * FROM run",
    "qrels_contains": _with(QRELS) + "\nSELECT query_id, doc_id FROM qrels",
    "judged_table": _with(JUDGED) + "\nSELECT query_id, query, doc_id, text, query_docs FROM judged",
    "query_docs_count": _with(JUDGED) + "\nSELECT DISTINCT query_id, query_docs FROM judged",
    "bm25_flagged": _with(INDEX, bm25("run", 10), QRELS) + """
SELECT r.query_id, r.doc_id, r.score, r.rnk, (q.doc_id IS NOT NULL) AS relevant, d.text
FROM run r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id
JOIN documents d ON d.doc_id = r.doc_id""",
    "bm25_missing_docs": _with(INDEX, bm25("run", 10), QRELS) + """
SELECT q.query_id, q.doc_id FROM qrels q
WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.query_id = q.query_id AND r.doc_id = q.doc_id)""",
    "bm25_run_summary": _with(INDEX, bm25("run", 10), QRELS) + """,
nrel AS (SELECT query_id, count(*)::BIGINT AS n_rel FROM qrels GROUP BY query_id),
agg AS (
  SELECT r.query_id, count(*)::BIGINT AS n_answers, sum((q.doc_id IS NOT NULL)::BIGINT)::BIGINT AS hit
  FROM run r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id GROUP BY r.query_id)
SELECT n.query_id, coalesce(a.n_answers, 0)::BIGINT AS n_answers, n.n_rel,
       coalesce(a.hit, 0)::BIGINT AS n_retrieved_relevant, (n.n_rel - coalesce(a.hit, 0))::BIGINT AS n_missing
FROM nrel n LEFT JOIN agg a USING (query_id)""",
    "bm25_curve": _with(INDEX, BM100, QRELS, curve("cur", "lex")) + "\nSELECT * FROM cur",
    "bm25_mean_curve": _with(INDEX, BM100, QRELS, curve("cur", "lex"), mean("m", "cur")) + "\nSELECT * FROM m",
    "l2_top10": _with(vec_run("run", 10)) + "\nSELECT * FROM run",
    "l2_distance_top10": _with(vec_run("run", 10, "dist")) + "\nSELECT * FROM run",
    "cosine_top10": _with(vec_run("run", 10, "cosine")) + "\nSELECT * FROM run",
    "l2_top10_grid": _with(vec_run("run", 10)) + "\nSELECT * FROM run",
    "l2_top10_cells": _with(vec_run("run", 10)) + "\nSELECT * FROM run",
    "vector_store_top10": _with(vec_run("run", 10)) + "\nSELECT * FROM run",
    "qrels_single_words": r"""
SELECT DISTINCT b.item_id AS query_id, d.doc_id
FROM (SELECT item_id, regexp_extract(text, '^[^\x20\x09-\x0D]+') AS word FROM benchmark) b JOIN documents d ON contains(d.text, b.word)
WHERE length(b.word) > 0""",
    "l2_curve": _with(vec_run("run", 100), label_curve("cur", "run")) + "\nSELECT * FROM cur",
    "l2_mean_curve": _with(vec_run("run", 100), label_curve("cur", "run"), mean("m", "cur")) + "\nSELECT * FROM m",
    "l2_run_summary": _with(vec_run("run", 10), label_curve("cur", "run")) + """,
agg AS (SELECT query_id, count(*)::BIGINT AS n_answers, sum(relevant::BIGINT)::BIGINT AS hit
        FROM cur_flag GROUP BY query_id)
SELECT n.query_id, coalesce(a.n_answers, 0)::BIGINT AS n_answers, n.n_rel,
       coalesce(a.hit, 0)::BIGINT AS n_retrieved_relevant, (n.n_rel - coalesce(a.hit, 0))::BIGINT AS n_missing
FROM cur_nrel n LEFT JOIN agg a USING (query_id)""",
    "hash_embed_docs": _with(hash_cells("hd", "documents", "doc_id", "text")) + """
SELECT c.id AS doc_id, c.dim, round(c.v / n.nrm, 9) AS value
FROM hd_c c JOIN hd_n n USING (id) WHERE c.v <> 0""",
    "hash_l2_top10": _with(hash_run("run", 10)) + "\nSELECT * FROM run",
    "hash_l2_missing_docs": _with(hash_run("run", 10), QRELS) + """
SELECT q.query_id, q.doc_id FROM qrels q
WHERE NOT EXISTS (SELECT 1 FROM run r WHERE r.query_id = q.query_id AND r.doc_id = q.doc_id)""",
    "rrf_two_lists": _with(INDEX, BM100, HASH100, rrf2("fz", "lex", "vec")) + "\nSELECT * FROM fz",
    "rrf_nlists": _with(INDEX, BM100, HASH100) + """,
tagged AS (SELECT query_id, doc_id, (rnk - 1)::DOUBLE AS r FROM lex
           UNION ALL SELECT query_id, doc_id, (rnk - 1)::DOUBLE AS r FROM vec),
pd AS (SELECT query_id, doc_id, sum(1.0 / (60.0 + r)) AS present, count(*)::BIGINT AS n_lists
       FROM tagged GROUP BY query_id, doc_id),
pn AS (SELECT *, (count(*) OVER (PARTITION BY query_id))::DOUBLE AS n FROM pd),
sc AS (SELECT query_id, doc_id, n_lists, round(present + (2 - n_lists) * (1.0 / (60.0 + n)), 9) AS rerank FROM pn)
SELECT query_id, doc_id, n_lists, rerank,
       (row_number() OVER (PARTITION BY query_id ORDER BY rerank DESC, doc_id ASC))::INTEGER AS rnk
FROM sc""",
    "rrf_mean_curve": _with(INDEX, BM100, HASH100, rrf2("fz", "lex", "vec"), QRELS, curve("cur", "fz"),
                            mean("m", "cur")) + "\nSELECT * FROM m",
    "rerank_overlap": _with(INDEX, BM100, PAIR_RUN) + "\nSELECT * FROM ov",
    "rerank_overlap_mean_curve": _with(INDEX, BM100, PAIR_RUN, QRELS, curve("cur", "ov", "new_rnk"),
                                       mean("m", "cur")) + "\nSELECT * FROM m",
    "softmax_pair_probability": _with(INDEX, BM100, PAIR_RUN) + """
SELECT query_id, doc_id, round(1.0 / (1.0 + exp((-rerank) - rerank)), 9) AS p_relevant FROM ov""",
    "method_comparison_at5": _with(
        INDEX, BM100, HASH100, rrf2("fz", "lex", "vec"), PAIR_RUN, QRELS,
        curve("c1", "lex"), mean("m1", "c1"), curve("c2", "vec"), mean("m2", "c2"),
        curve("c3", "ov", "new_rnk"), mean("m3", "c3"), curve("c4", "fz"), mean("m4", "c4"),
        overlap("vo", "vec"), curve("c5", "vo", "new_rnk"), mean("m5", "c5")) + """
SELECT 'bm25' AS method, * FROM m1 WHERE top_k = 5
UNION ALL SELECT 'hash_l2' AS method, * FROM m2 WHERE top_k = 5
UNION ALL SELECT 'bm25_overlap' AS method, * FROM m3 WHERE top_k = 5
UNION ALL SELECT 'hash_l2_overlap' AS method, * FROM m5 WHERE top_k = 5
UNION ALL SELECT 'rrf' AS method, * FROM m4 WHERE top_k = 5""",
    "hash_l2_rerank_overlap": _with(HASH100, overlap("ov", "vec")) + "\nSELECT * FROM ov",
    "hash_l2_rerank_overlap_mean_curve": _with(HASH100, overlap("ov", "vec"), QRELS, curve("cur", "ov", "new_rnk"),
                                               mean("m", "cur")) + "\nSELECT * FROM m",
    "rrf_three_lists": _with(INDEX, BM100, HASH100, PAIR_RUN) + """,
tagged AS (SELECT query_id, doc_id, (rnk - 1)::DOUBLE AS r FROM lex
           UNION ALL SELECT query_id, doc_id, (rnk - 1)::DOUBLE AS r FROM vec
           UNION ALL SELECT query_id, doc_id, (new_rnk - 1)::DOUBLE AS r FROM ov),
pd AS (SELECT query_id, doc_id, sum(1.0 / (60.0 + r)) AS present, count(*)::BIGINT AS n_lists
       FROM tagged GROUP BY query_id, doc_id),
pn AS (SELECT *, (count(*) OVER (PARTITION BY query_id))::DOUBLE AS n FROM pd),
sc AS (SELECT query_id, doc_id, n_lists, round(present + (3 - n_lists) * (1.0 / (60.0 + n)), 9) AS rerank FROM pn)
SELECT query_id, doc_id, n_lists, rerank,
       (row_number() OVER (PARTITION BY query_id ORDER BY rerank DESC, doc_id ASC))::INTEGER AS rnk
FROM sc""",
    "score_regression": SCORE_REGRESSION,
    # The distribution function of Student's t for whole df, by the closed form of each term.
    "score_regression_pvalue": f"""
WITH reg AS ({SCORE_REGRESSION}),
ang AS (SELECT *, (n - 2) AS nu, atan(abs(t) / sqrt((n - 2)::DOUBLE)) AS th FROM reg WHERE t IS NOT NULL),
ser AS (
  SELECT query_id, nu, th, CASE WHEN nu = 1 THEN 0.0 ELSE list_sum(list_transform(range(0, nu // 2), lambda j:
    CASE WHEN nu % 2 = 1
         THEN exp(2 * j * ln(2) + 2 * lgamma(j + 1) - lgamma(2 * j + 2)) * cos(th) ** (2 * j + 1)
         ELSE exp(lgamma(2 * j + 1) - 2 * j * ln(2) - 2 * lgamma(j + 1)) * cos(th) ** (2 * j) END)) END AS s
  FROM ang),
pv AS (SELECT query_id, round(greatest(0.0, 1.0 - CASE WHEN nu % 2 = 1 THEN (th + sin(th) * s) * 2 / pi()
                                                       ELSE sin(th) * s END), 6) AS p FROM ser)
SELECT reg.*, pv.p FROM reg LEFT JOIN pv USING (query_id)""",
    "split_by_query": _with(SPLIT) + """
SELECT query_id, doc_id, 'train' AS part FROM train UNION ALL SELECT query_id, doc_id, 'test' AS part FROM test""",
    "split_profile": _with(SPLIT) + """
SELECT 'train' AS part, count(*)::BIGINT AS n_rows, count(DISTINCT query_id)::BIGINT AS n_queries,
       count(DISTINCT doc_id)::BIGINT AS n_docs FROM train
UNION ALL
SELECT 'test' AS part, count(*)::BIGINT, count(DISTINCT query_id)::BIGINT, count(DISTINCT doc_id)::BIGINT FROM test""",
    "negative_pairs": _with(NEGATIVES) + "\nSELECT query_id, doc_id, label FROM negs",
    "group_split": _with(GROUPS) + """
SELECT query_id, doc_id, label, CASE WHEN query_id IN (SELECT query_id FROM hit_ids)
                                     THEN 'train' ELSE 'validation' END AS part
FROM pairs""",
    "group_split_exact": _with(EXACT_GROUPS) + "\nSELECT query_id, doc_id, label, part FROM parts",
    "label_profile": _with(EXACT_GROUPS) + "\nSELECT part, label, count(*)::BIGINT AS n FROM parts GROUP BY part, label",
    "pair_features": _with(INDEX, bm25("lex", 1), NEGATIVES, "pt AS (SELECT query_id, doc_id, label, 0.0 AS score, 0 AS rnk FROM pairs)",
                           overlap("po", "pt"), hash_dense("hd", "documents", "doc_id", "text"), hash_dense("hq", "benchmark", "item_id", "text")) + f"""
SELECT p.query_id, p.doc_id, p.label, coalesce(l.score, 0.0) AS bm25, o.rerank AS overlap,
       round(ln(1.0 + len({tok('d.text')})), 9) AS log_dl, len({tok('b.text')})::DOUBLE AS nq,
       round({_sq_l2('hq.emb', 'hd.emb')}, 6) AS l2
FROM pt p JOIN po o USING (query_id, doc_id) LEFT JOIN lex_sc l USING (query_id, doc_id)
JOIN documents d ON d.doc_id = p.doc_id JOIN benchmark b ON b.item_id = p.query_id
JOIN hd ON hd.id = p.doc_id JOIN hq ON hq.id = p.query_id""",
    "model_hook_vectors": """
SELECT doc_id, length(t)::BIGINT AS chars, (length(t) - length(replace(t, ' ', '')))::BIGINT AS spaces,
       (length(t) - length(replace(t, 'e', '')))::BIGINT AS letters_e
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "model_hook_scores": _with(INDEX, bm25("run", 10)) + """
SELECT query_id, r.doc_id, round(1.0 / (1.0 + exp(length(coalesce(b.text, '')) / 100.0 - length(coalesce(d.text, '')) / 1000.0)), 9) AS p_relevant
FROM run r JOIN benchmark b ON b.item_id = r.query_id JOIN documents d ON d.doc_id = r.doc_id""",
    "labelled_pairs": _with(NEGATIVES) + """
SELECT query_id, doc_id, query, text, label FROM pairs""",
    "frequency_tables": _with(JUDGED) + """
SELECT 'query' AS kind, query_id AS key, count(*)::BIGINT AS n FROM judged GROUP BY query_id
UNION ALL SELECT 'doc' AS kind, doc_id AS key, count(*)::BIGINT AS n FROM judged GROUP BY doc_id""",
    "query_snapshot20": _with(JUDGED) + """
SELECT DISTINCT query_id, query, query_docs FROM judged ORDER BY query_docs, query_id LIMIT 20""",
    "query_slug": "SELECT item_id AS query_id, translate(text, ' .', '_') AS slug FROM benchmark",
    "bm25_padded_top10": _with(INDEX, bm25("run", 10)) + """,
pad_ids AS (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 10),
pads AS (
  SELECT b.item_id AS query_id, p.doc_id, 0.0::DOUBLE AS score
  FROM benchmark b CROSS JOIN pad_ids p
  WHERE NOT EXISTS (SELECT 1 FROM run_sc s WHERE s.query_id = b.item_id AND s.doc_id = p.doc_id)),
allsc AS (SELECT query_id, doc_id, score FROM run_sc UNION ALL SELECT query_id, doc_id, score FROM pads)
SELECT query_id, doc_id, score, rnk FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id ASC))::INTEGER AS rnk
  FROM allsc) WHERE rnk <= 10""",
    "answers_tsv_roundtrip": _with(INDEX, bm25("run", 10), QRELS) + """
SELECT r.query_id, r.doc_id, r.score, r.rnk, CASE WHEN q.doc_id IS NOT NULL THEN 'yes' ELSE 'no' END AS relevant,
       d.text
FROM run r LEFT JOIN qrels q ON q.query_id = r.query_id AND q.doc_id = r.doc_id
JOIN documents d ON d.doc_id = r.doc_id""",
    "per_query_export": _with(INDEX, bm25("run", 10)) + """
SELECT r.query_id, translate(b.text, ' .', '_') AS query_slug, r.doc_id, r.score, r.rnk
FROM run r JOIN benchmark b ON b.item_id = r.query_id""",
    "fused_tsv_roundtrip": _with(INDEX, BM100, HASH100, rrf2("fz", "lex", "vec")) + """
SELECT query_id, doc_id, rank1, rank2, round(rerank::DECIMAL(38, 18), 5)::DECIMAL(38, 5)::VARCHAR AS rerank, rnk FROM fz""",
    "incremental_index_state": _with(INDEX) + "\nSELECT term, df FROM term_stats",
    "incremental_corpus_stats": _with(INDEX) + """
SELECT n_docs, total_len, total_len::DOUBLE / n_docs::DOUBLE AS avgdl FROM cstats""",
    "incremental_vectors": _with(hash_cells("hd", "documents", "doc_id", "text")) + """
SELECT c.id AS doc_id, c.dim, round(c.v / n.nrm, 9) AS value
FROM hd_c c JOIN hd_n n USING (id) WHERE c.v <> 0""",
    "incremental_distinct_counts": _with(INDEX) + """
SELECT 'term' AS counted, count(*)::BIGINT AS exact, true AS estimate_within_bound FROM term_stats
UNION ALL SELECT 'doc_id', count(DISTINCT doc_id)::BIGINT, true FROM documents""",
    "stream_answers": _with(INDEX, bm25("run", 10)) + "\nSELECT * FROM run",
    "stream_answers_fused": _with(INDEX, BM100, HASH100, rrf2("fz", "lex", "vec")) + "\nSELECT * FROM fz",
}
ORACLE_SQL["answers_jsonl_roundtrip"] = ORACLE_SQL["answers_tsv_roundtrip"]
