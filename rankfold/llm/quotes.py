"""Quotation linking: quoted passages are joined to the messages they come from.

A line's quote level is the number of ``>`` marks in front of it. Consecutive
lines of one level form a passage. A message says a passage if it holds the
passage's lines in a row (as its own lines, empty ones aside), or if the passage,
its lines joined, is one of its lines or its whole own text (a quote that was
wrapped anew). Lines are normalised (lower case, white space runs to one space,
trimmed). Both sides are hashed: every passage by its lines and by its joined
text, every message by each line, its whole text, and its runs of as many lines
as some passage has; equal hashes link.

The original is the first message of the same conversation, before the quoting
one, that says the passage; failing that, the first other conversation's
message (smallest conv_id, then turn): the two smallest conversations of a hash
are kept, one of which is another than the quoting message's own. A message
replies to the latest turn among its linked level-1 passages.

The result has one row per message, with its place in the conversation (1 +
messages of smaller turns, so ties share a place), its thread (the turn its
replies lead back to) and its place in reply order: threads by their first turn,
a thread's messages by turn, so an original comes before its replies; and its own
text without quotes. DataFrame functions only.

Null text: no passages, own text empty. Null conv_id or turn: the message is
kept, never an original, links to nothing in its conversation and is a thread of
its own. Repeated rows give repeated rows. A passage that is empty when normalised
links to nothing. Messages that share a turn share a thread. Each hash is reduced
to its first message a conversation, and to two conversations, before the joins,
so a line said by everyone joins one row. Threads are found by doubling: each
round halves the way back to the first turn. Places are summed over blocks of
threads and turns, so a single conversation that holds most rows isn't ordered by
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankfold.llm.common import text_rows, written

QUOTED = r"^(?:[\x20\x09]*>)+"
TURN_BLOCK = 4096


def normalised(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"[\x20\x09-\x0D]+", " "))


def own_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: ~x.rlike(QUOTED))


def runs_key(lines: Column) -> Column:
    """The hash of lines in a row; of a single line or joined text it is another."""
    return F.md5(F.concat(F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n")))


def passages(messages: DataFrame) -> DataFrame:
    """One row per quoted passage: conv_id, turn, message, level, run, hash (joined text), lines (hash of its lines), n."""
    x = (messages.where(F.col("text").rlike("(?m)" + QUOTED)).select("conv_id", "turn", "message", "text").distinct()
         .select("conv_id", "turn", "message", F.posexplode(F.split("text", "\n")).alias("pos", "line")))
    marks = F.regexp_extract("line", QUOTED, 0)
    x = x.select("conv_id", "turn", "message", "pos", F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
                 F.regexp_replace("line", QUOTED, "").alias("body"))
    one = Window.partitionBy("conv_id", "turn", "message").orderBy("pos")  # the lines of one message
    x = x.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(one)).cast("int"))
    x = x.withColumn("run", F.sum("new").over(one)).where("level > 0")
    x = x.groupBy("conv_id", "turn", "message", "level", "run").agg(F.sort_array(F.collect_list(F.struct("pos", "body"))).alias("b"))
    bodies = F.transform("b", lambda y: y["body"])
    x = x.withColumn("said", normalised(F.array_join(bodies, " "))).withColumn("ls", F.filter(F.transform(bodies, normalised), lambda u: u != ""))
    return x.select("conv_id", "turn", "message", "level", "run", F.when(F.col("said") != "", F.md5("said")).alias("hash"),
                    F.when(F.size("ls") > 1, runs_key(F.col("ls"))).alias("lines"), F.size("ls").alias("n"))


def units(messages: DataFrame, lengths: list[int] = ()) -> DataFrame:
    """conv_id, turn and hash of everything a message itself says: lines, whole text, and runs of so many lines."""
    x = messages.where("conv_id is not null and turn is not null and text is not null")
    own = own_lines(F.col("text"))
    ls = F.filter(F.transform(own, normalised), lambda u: u != "")
    whole = F.filter(F.array(normalised(F.array_join(own, " "))), lambda u: u != "")
    x = x.select("conv_id", "turn", ls.alias("ls"), whole.alias("whole"))
    hashes = F.concat("whole", "ls")
    said = F.transform(hashes, lambda u: F.md5(u))
    if lengths:
        fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.size("ls"))
        runs = F.flatten(F.transform(fitting, lambda n: F.transform(F.sequence(F.lit(1), F.size("ls") - n + 1), lambda i: runs_key(F.slice("ls", i, n)))))
        said = F.concat(said, runs)
    return x.select("conv_id", "turn", F.explode(F.array_distinct(said)).alias("hash"))


def roots(parents: DataFrame) -> DataFrame:
    """conv_id, turn, thread from (conv_id, turn, up): ``up`` is an earlier turn of the conversation, or null."""
    x = written(parents.select("conv_id", "turn", F.col("up").alias("up"), F.coalesce("up", "turn").alias("thread")), "quotes-ways")
    while not x.where("up is not null").isEmpty():
        at = x.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("next"), F.col("thread").alias("far"))
        way = x.where("up is not null").join(at, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("t")), "left")
        way = way.select("conv_id", "turn", F.col("next").alias("up"), F.coalesce("far", "thread").alias("thread"))
        x = written(x.where("up is null").unionByName(way), "quotes-ways")
    return x.select("conv_id", "turn", "thread")


def places(messages: DataFrame) -> DataFrame:
    """1 + the messages of smaller turns, per conversation and turn."""
    turns = messages.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    turns = turns.withColumn("block", F.floor(F.col("turn") / TURN_BLOCK))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = turns.groupBy("conv_id", "block").agg(F.sum("n").alias("m"))
    sums = sums.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    x = turns.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return x.select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"),
                    (F.col("before") + F.coalesce(F.sum("n").over(within), F.lit(0)) + 1).alias("place"))


def thread_places(turns: DataFrame) -> DataFrame:
    """tc, tt, thread_place from (conv_id, turn, thread, n): 1 + the messages before, by thread, then turn."""
    x = turns.withColumn("tb", F.floor(F.col("thread") / TURN_BLOCK)).withColumn("ub", F.floor(F.col("turn") / TURN_BLOCK))
    before = lambda by, order, n: F.coalesce(F.sum(n).over(
        Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = x.groupBy("conv_id", "tb", "thread", "ub").agg(F.sum("n").alias("m"))
    blocks = sums.groupBy("conv_id", "tb").agg(F.sum("m").alias("b"))
    blocks = blocks.select(F.col("conv_id").alias("bc"), F.col("tb").alias("bt"), before(["conv_id"], ["tb"], "b").alias("outer"))
    sums = sums.select(F.col("conv_id").alias("sc"), F.col("tb").alias("sb"), F.col("thread").alias("st"), F.col("ub").alias("su"),
                       before(["conv_id", "tb"], ["thread", "ub"], "m").alias("middle"))
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    x = x.withColumn("inner", before(["conv_id", "tb", "thread", "ub"], ["turn"], "n"))
    x = x.join(sums, same("conv_id", "sc") & same("tb", "sb") & same("thread", "st") & same("ub", "su"))
    x = x.join(blocks, same("conv_id", "bc") & same("tb", "bt"))
    return x.select(F.col("conv_id").alias("tc"), F.col("turn").alias("tt"), "thread", (F.col("outer") + F.col("middle") + F.col("inner") + 1).alias("thread_place"))


def link(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, place, n_passages, n_linked, max_level, reply_to_turn, quoted_conv, thread, thread_place, own_text."""
    m = text_rows(conversations, "conv_id", "turn", "role", "text").withColumn("message", F.md5("text"))
    p = written(passages(m), "quotes-passages")
    lengths = sorted(r[0] for r in p.where("n > 1").select("n").distinct().collect())  # at most as many as a text has lines
    said = units(m, lengths).groupBy("conv_id", "hash").agg(F.min("turn").alias("first"))
    asked = p.select("hash").unionByName(p.select(F.col("lines").alias("hash"))).where("hash is not null").distinct()
    said = written(said.join(asked, "hash", "left_semi"), "quotes-said")  # what someone quotes
    two = Window.partitionBy("hash").orderBy("conv_id")
    pair = said.withColumn("r", F.row_number().over(two)).where("r <= 2").groupBy("hash").agg(
        F.min(F.when(F.col("r") == 1, F.col("conv_id"))).alias("c1"), F.min(F.when(F.col("r") == 2, F.col("conv_id"))).alias("c2"))
    for key in ("hash", "lines"):
        here = said.select(F.col("conv_id").alias("hc"), F.col("hash").alias("hh"), F.col("first").alias(f"first_{key}"))
        p = p.join(here, (F.col("conv_id") == F.col("hc")) & (F.col(key) == F.col("hh")) & (F.col(f"first_{key}") < F.col("turn")), "left").drop("hc", "hh")
        two_of = pair.select(F.col("hash").alias("ph"), "c1", "c2")
        p = p.join(two_of, F.col(key) == F.col("ph"), "left")
        other = F.when(F.col("c1") != F.col("conv_id"), F.col("c1")).otherwise(F.col("c2"))
        p = p.withColumn(f"other_{key}", F.when(F.col("conv_id").isNotNull(), other)).drop("ph", "c1", "c2")
    first = F.least("first_hash", "first_lines")  # null only if both are
    p = p.withColumn("first", first).withColumn("oc", F.when(F.col("first").isNull(), F.least("other_hash", "other_lines")))
    per = p.groupBy("conv_id", "turn", "message").agg(
        F.count(F.lit(1)).alias("n_passages"),
        F.count(F.when(F.col("first").isNotNull() | F.col("oc").isNotNull(), 1)).alias("n_linked"),
        F.max("level").cast("long").alias("max_level"),
        F.max(F.when(F.col("level") == 1, F.col("first"))).alias("reply_to_turn"),
        F.min("oc").alias("quoted_conv")).select(F.col("conv_id").alias("lc"), F.col("turn").alias("lt"),
                                                 F.col("message").alias("lm"), "n_passages", "n_linked", "max_level",
                                                 "reply_to_turn", "quoted_conv")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    x = m.join(per, same("conv_id", "lc") & same("turn", "lt") & same("message", "lm"), "left")
    x = x.join(places(m), same("conv_id", "pc") & same("turn", "pt"))
    turns = m.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    ups = per.where("lc is not null and lt is not null").groupBy("lc", "lt").agg(F.max("reply_to_turn").alias("up")).where("up is not null")
    turns = written(turns.join(ups, (F.col("conv_id") == F.col("lc")) & (F.col("turn") == F.col("lt")), "left").select("conv_id", "turn", "n", "up"),
                    "quotes-turns")
    found = roots(turns).select(F.col("conv_id").alias("rc"), F.col("turn").alias("rt"), "thread")
    threads = thread_places(turns.join(found, same("conv_id", "rc") & same("turn", "rt")).select("conv_id", "turn", "thread", "n"))
    x = x.join(threads, same("conv_id", "tc") & same("turn", "tt"))
    own = F.trim(F.array_join(own_lines(F.col("text")), "\n"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return x.select("conv_id", "turn", "role", F.col("place").cast("long").alias("place"), zero("n_passages"), zero("n_linked"),
                    zero("max_level"), "reply_to_turn", "quoted_conv", "thread", F.col("thread_place").cast("long").alias("thread_place"),
                    F.coalesce(own, F.lit("")).alias("own_text"))


#: Plain comparison of every passage with every message, by the lines themselves.
ORACLE = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, text, md5(text) AS message, string_split(text, chr(10)) AS ls FROM conversations),
own AS (SELECT *, list_filter(ls, lambda x: NOT regexp_matches(x, '^([\x20\x09]*>)+')) AS ol FROM m),
unit AS (SELECT DISTINCT conv_id, turn,
  list_filter(list_transform(ol, lambda u: trim(regexp_replace(lower(u), '[\x20\x09-\x0D]+', ' ', 'g'))), lambda u: u <> '') AS nl,
  trim(regexp_replace(lower(array_to_string(ol, ' ')), '[\x20\x09-\x0D]+', ' ', 'g')) AS whole
  FROM own WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL),
line AS (SELECT conv_id, turn, message, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT DISTINCT conv_id, turn, message, ls FROM m)),
lev AS (SELECT *, length(regexp_replace(regexp_extract(line, '^([\x20\x09]*>)+', 0), '[^>]', '', 'g')) AS level,
  regexp_replace(line, '^([\x20\x09]*>)+', '') AS body FROM line),
chg AS (SELECT *, (level <> lag(level, 1, -1) OVER (PARTITION BY conv_id, turn, message ORDER BY pos))::INT AS new FROM lev),
run AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn, message ORDER BY pos) AS run,
  trim(regexp_replace(lower(body), '[\x20\x09-\x0D]+', ' ', 'g')) AS nb FROM chg),
pas AS (SELECT conv_id, turn, message, level, run,
  trim(regexp_replace(lower(string_agg(body, ' ' ORDER BY pos)), '[\x20\x09-\x0D]+', ' ', 'g')) AS said,
  string_agg(nb, chr(10) ORDER BY pos) FILTER (nb <> '') AS lines
  FROM run WHERE level > 0 GROUP BY ALL),
hit AS (SELECT p.conv_id, p.turn, p.message, p.level, p.run, u.conv_id AS uc, u.turn AS ut FROM pas p JOIN unit u
  ON p.said <> '' AND (p.said = u.whole OR list_contains(u.nl, p.said)
    OR contains(chr(10) || array_to_string(u.nl, chr(10)) || chr(10), chr(10) || p.lines || chr(10)))),
lk AS (SELECT p.conv_id, p.turn, p.message, p.level, p.run, min(h.ut) FILTER (h.uc = p.conv_id AND h.ut < p.turn) AS first,
  min(h.uc) FILTER (h.uc <> p.conv_id) AS other FROM pas p LEFT JOIN hit h ON h.conv_id IS NOT DISTINCT FROM p.conv_id
  AND h.turn IS NOT DISTINCT FROM p.turn AND h.message = p.message AND h.run = p.run GROUP BY ALL),
per AS (SELECT conv_id, turn, message, count(*) AS n_passages, count(*) FILTER (first IS NOT NULL OR other IS NOT NULL) AS n_linked,
  max(level)::BIGINT AS max_level, max(CASE WHEN level = 1 THEN first END) AS reply_to_turn, min(CASE WHEN first IS NULL THEN other END) AS quoted_conv
  FROM lk GROUP BY ALL),
pl AS (SELECT conv_id, turn, (1 + coalesce(sum(count(*)) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS place
  FROM m GROUP BY conv_id, turn),
up AS (SELECT conv_id, turn, max(reply_to_turn) AS up FROM per WHERE reply_to_turn IS NOT NULL GROUP BY ALL),
way AS (SELECT DISTINCT conv_id, turn, turn AS node FROM m
  UNION SELECT w.conv_id, w.turn, u.up FROM way w JOIN up u ON u.conv_id = w.conv_id AND u.turn = w.node),
th AS (SELECT conv_id, turn, min(node) AS thread FROM way GROUP BY ALL),
tp AS (SELECT m.conv_id, m.turn, any_value(th.thread) AS thread, (1 + coalesce(sum(count(*)) OVER (PARTITION BY m.conv_id
  ORDER BY any_value(th.thread) NULLS FIRST, m.turn NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS thread_place
  FROM m JOIN th ON th.conv_id IS NOT DISTINCT FROM m.conv_id AND th.turn IS NOT DISTINCT FROM m.turn GROUP BY m.conv_id, m.turn)
SELECT o.conv_id, o.turn, o.role, pl.place, coalesce(n_passages, 0)::BIGINT AS n_passages, coalesce(n_linked, 0)::BIGINT AS n_linked,
  coalesce(max_level, 0)::BIGINT AS max_level, reply_to_turn, quoted_conv, tp.thread, tp.thread_place,
  coalesce(trim(array_to_string(ol, chr(10))), '') AS own_text
FROM own o JOIN pl ON o.conv_id IS NOT DISTINCT FROM pl.conv_id AND o.turn IS NOT DISTINCT FROM pl.turn
JOIN tp ON o.conv_id IS NOT DISTINCT FROM tp.conv_id AND o.turn IS NOT DISTINCT FROM tp.turn
LEFT JOIN per ON o.conv_id IS NOT DISTINCT FROM per.conv_id AND o.turn IS NOT DISTINCT FROM per.turn AND o.message = per.message
"""
