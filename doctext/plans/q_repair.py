"""Registered queries: word list and dictionary word repair (S3, M1-M7).

Input: the documents with words broken apart (``replace(text, 'er', 'e r')``)
and the word list made from ``benchmark``.  The oracle SQL is written
set-wise (every (start, offset) pair and the first stop by ``min``), not as
the fold the Spark plan uses, and the walk follows "next kept word"
pointers found with an as-of join.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import repair as rp
from ..session import scratch_path
from ..sources.dictionary import load_word_files, words_from_texts
from ..schema import WORD_STRIP
from .params import SETTINGS as S
from .registry import query

Q = tx.sql_quote
W, MAXL, MINL = S.window_size, S.word_max_length, S.word_min_length


def broken_docs(c):
    # the repair places documents by key itself, so the raw scan is used
    d = c.raw("documents").select("doc_id", F.replace("text", F.lit("er"), F.lit("e r")).alias("text"))
    return d


def word_list(c):
    return words_from_texts(c.raw("benchmark"))


def run_repair(c):
    return rp.repair(broken_docs(c), "doc_id", "text", word_list(c), S)


@query("dictionary", "SELECT word FROM dictionary")
def dictionary(c):
    return word_list(c)


@query("word_files", f"""
SELECT DISTINCT lower(trim(w, {Q(tx.PY_SPACES)})) AS word
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\n\\r]')) AS w FROM benchmark) x
WHERE trim(w, {Q(tx.PY_SPACES)}) <> ''""")
def word_files(c):
    """S3: word lists from line files, one word a line (here: two files, with
    white space around the words)."""
    words = c.raw("benchmark").select(F.explode(F.split("text", "[ \n\r]")).alias("w"))
    paths = [scratch_path(c.spark, "words") for _ in range(2)]
    for i, path in enumerate(paths):
        words.where(F.pmod(F.hash("w"), F.lit(2)) == i).select(F.concat(F.lit("\t "), "w", F.lit(" \u00a0"))).write.text(path)
    return load_word_files(c.spark, paths)


WORDS_RE2 = f"list_filter(list_transform(string_split(text, ' '), lambda w: trim(w, {Q(WORD_STRIP)})), lambda w: w <> '')"
TOKENS_SQL = f"""
SELECT doc_id, i - 1 AS pos, arr[i] AS word FROM (
  SELECT doc_id, arr, unnest(generate_series(1, len(arr))) AS i FROM (
    SELECT doc_id, {WORDS_RE2} AS arr FROM (SELECT doc_id, replace(text, 'er', 'e r') AS text FROM documents) d) a) b"""


@query("word_valid", """
SELECT t.doc_id, t.pos, t.word, (d.word IS NOT NULL AND length(t.word) > 0) AS valid
FROM raw_tokens t LEFT JOIN dictionary d ON d.word = lower(t.word)""", {"raw_tokens": TOKENS_SQL})
def word_valid(c):
    t = broken_docs(c).select("doc_id", F.posexplode(tx.words("text", " ")).alias("pos", "word"))
    return rp.word_valid(t, word_list(c), S, "word")


def _is_url(x):
    return f"(ends_with({x}, '.de') OR ends_with({x}, '.com') OR starts_with({x}, 'http'))"


def _is_email(x):
    return f"(length({x}) > 7 AND regexp_matches({x}, '^[^@]+@[^@]+\\.[^@]+'))"


PRE_SQL = f"""
WITH comp AS (
  SELECT doc_id, pos, word AS w, translate(word, '._-', '') AS merged,
    list_filter(list_transform(regexp_split_to_array(word, '[._\\-]'), lambda p: trim(p, {Q(WORD_STRIP)})), lambda p: p <> '') AS parts
  FROM raw_tokens
  WHERE regexp_matches(word, '[._\\-]') AND NOT {_is_url('word')} AND NOT {_is_email('word')}),
look AS (
  SELECT doc_id, pos, -1 AS idx, merged AS lw FROM comp
  UNION ALL
  SELECT doc_id, pos, i - 1, parts[i] FROM (SELECT doc_id, pos, parts, unnest(generate_series(1, len(parts))) AS i FROM comp) x),
verdict AS (
  SELECT l.doc_id, l.pos,
    bool_or(l.idx = -1 AND d.word IS NOT NULL AND length(l.lw) > 0) AS merged_ok,
    coalesce(bool_and(CASE WHEN l.idx >= 0 THEN d.word IS NOT NULL AND length(l.lw) > 1 END), true) AS parts_ok
  FROM look l LEFT JOIN dictionary d ON d.word = lower(l.lw) GROUP BY l.doc_id, l.pos),
exp AS (
  SELECT c.doc_id, c.pos,
    CASE WHEN v.merged_ok THEN [c.merged] WHEN len(c.parts) = 0 THEN [c.merged]
         WHEN v.parts_ok THEN [c.w] ELSE c.parts END AS exp,
    NOT v.merged_ok AND len(c.parts) > 0 AND v.parts_ok AS compound
  FROM comp c JOIN verdict v ON v.doc_id = c.doc_id AND v.pos = c.pos),
allx AS (
  SELECT t.doc_id, t.pos, coalesce(e.exp, [t.word]) AS exp, coalesce(e.compound, false) AS compound
  FROM raw_tokens t LEFT JOIN exp e ON e.doc_id = t.doc_id AND e.pos = t.pos),
flat AS (
  SELECT doc_id, pos, i, exp[i] AS token, compound FROM (
    SELECT doc_id, pos, exp, compound, unnest(generate_series(1, len(exp))) AS i FROM allx) y)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pos, i) - 1 AS INTEGER) AS pos, token, compound
FROM flat"""


@query("preprocess_tokens", "SELECT doc_id, pos, token, compound FROM pre_tokens",
       {"raw_tokens": TOKENS_SQL, "pre_tokens": PRE_SQL})
def preprocess_tokens(c):
    return rp.preprocess_tokens(broken_docs(c), "doc_id", "text", word_list(c), S)


def _upper_word(x):
    return f"(upper({x}) = {x} AND lower({x}) <> {x})"


# Glued words are substrings of the document's tokens written without gaps:
# every token knows where it begins, a (start, end) pair is two offsets.  A
# pair further right than the first token rule that ends the window (upper
# case, digit) or than the length limit is never made.
SPANS_SQL = f"""
WITH t AS (
  SELECT doc_id, pos, token, compound,
    CASE WHEN compound THEN token || repeat('|', 9) ELSE token END AS g,
    {_upper_word('left(token, 1)')} AS up, regexp_matches(token, '\\p{{Nd}}') AS dig
  FROM pre_tokens)
SELECT doc_id, pos, token, compound, up, dig,
  sum(length(g)) OVER d - length(g) AS b, sum(length(g)) OVER d AS e,
  min(CASE WHEN up THEN pos END) OVER later AS next_up, min(CASE WHEN dig THEN pos END) OVER from_here AS next_dig
FROM t
WINDOW d AS (PARTITION BY doc_id ORDER BY pos),
  later AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
  from_here AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""

GLUED_SQL = """
SELECT doc_id, string_agg(CASE WHEN compound THEN token || repeat('|', 9) ELSE token END, '' ORDER BY pos) AS g
FROM pre_tokens GROUP BY doc_id"""

PAIRS_SQL = f"""
SELECT *, ({_is_email('acc')} OR {_is_url('acc')} OR
           (length(acc) >= {MINL} AND (length(acc) >= {MAXL} OR {_upper_word('acc')}))) AS stop
FROM (
  SELECT s.doc_id, s.pos, z.pos - s.pos AS j, substring(g.g, CAST(s.b + 1 AS BIGINT), CAST(z.e - s.b AS BIGINT)) AS acc
  FROM spans s JOIN spans z ON z.doc_id = s.doc_id AND z.pos >= s.pos AND z.pos < s.pos + {W}
    AND z.pos < coalesce(s.next_up, z.pos + 1) AND z.pos < coalesce(s.next_dig, z.pos + 1)
    AND z.b - s.b < {MAXL}
  JOIN glued g ON g.doc_id = s.doc_id
  WHERE NOT s.compound) x"""

FIRSTS_SQL = """
SELECT doc_id, pos, min(CASE WHEN stop THEN j END) AS fs, bool_or(length(acc) < {MINL}) AS short
FROM pairs GROUP BY doc_id, pos""".replace("{MINL}", str(MINL))

CANDS_SQL = f"""
SELECT p.doc_id, p.pos, p.j, p.acc AS word
FROM pairs p JOIN firsts f ON f.doc_id = p.doc_id AND f.pos = p.pos
WHERE (f.fs IS NULL OR p.j < f.fs) AND length(p.acc) >= {MINL}"""

MATCHED_SQL = """
SELECT doc_id, pos, CAST(pos + max(j) + 1 AS INTEGER) AS "end", arg_max(x.word, j) AS word
FROM cands x JOIN dictionary d ON d.word = lower(x.word)
GROUP BY doc_id, pos
UNION ALL
SELECT doc_id, pos, pos + 1, token FROM pre_tokens WHERE compound"""

NEXT_SQL = """
SELECT m1.doc_id, m1.pos, m1."end", m1.word, m2.pos AS nxt
FROM matched m1 ASOF LEFT JOIN matched m2 ON m1.doc_id = m2.doc_id AND m2.pos >= m1."end" """

KEPT_SQL = """
WITH RECURSIVE walk(doc_id, pos, "end", word, nxt) AS (
  SELECT n.doc_id, n.pos, n."end", n.word, n.nxt FROM nexts n
  WHERE n.pos = (SELECT min(pos) FROM matched m WHERE m.doc_id = n.doc_id)
  UNION ALL
  SELECT n.doc_id, n.pos, n."end", n.word, n.nxt FROM walk w JOIN nexts n
    ON n.doc_id = w.doc_id AND n.pos = w.nxt)
SELECT doc_id, pos, "end", word FROM walk"""

REPAIR_CTES = {
    "raw_tokens": TOKENS_SQL, "pre_tokens": PRE_SQL, "spans": SPANS_SQL, "glued": GLUED_SQL, "pairs": PAIRS_SQL,
    "firsts": FIRSTS_SQL, "cands": CANDS_SQL, "matched": MATCHED_SQL, "nexts": NEXT_SQL, "kept": KEPT_SQL,
}


# The rows themselves (millions) are too many for a side-by-side run, so they
# are compared as counts and checksums per document and offset.
@query("window_candidates", """
SELECT doc_id, CAST(j AS INTEGER) AS j, count(*) AS n, sum(length(word)) AS chars, min(word) AS first_word, max(word) AS last_word,
  sum(CAST('0x' || left(md5(word), 8) AS BIGINT)) AS checksum
FROM cands GROUP BY doc_id, j""", REPAIR_CTES)
def window_candidates(c):
    pre = rp.prepared(broken_docs(c), "doc_id", "text", word_list(c), S)
    return (rp.candidates(pre, "doc_id", S, "|" * 9).groupBy("doc_id", "j")
            .agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"),
                 F.min("first_word").alias("first_word"), F.max("last_word").alias("last_word"),
                 F.sum("checksum").alias("checksum")))


@query("longest_match", 'SELECT doc_id, pos, "end", word FROM matched', REPAIR_CTES)
def longest_match(c):
    return run_repair(c).best


@query("clear_text", """
SELECT d.doc_id, coalesce(k.text_clear, '') AS text_clear FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text_clear FROM kept GROUP BY doc_id) k
ON k.doc_id = d.doc_id""", REPAIR_CTES)
def clear_text(c):
    return run_repair(c).text


@query("wrong_words", """
SELECT tk.doc_id, tk.pos, tk.token AS word
FROM spans tk LEFT JOIN firsts f ON f.doc_id = tk.doc_id AND f.pos = tk.pos
ASOF LEFT JOIN kept k ON k.doc_id = tk.doc_id AND k.pos <= tk.pos
WHERE (tk.compound OR NOT (coalesce(f.fs IS NOT NULL OR f.short, false)
                           OR coalesce(tk.next_dig < tk.pos + {W} AND (tk.next_up IS NULL OR tk.next_dig < tk.next_up), false)))
  AND (k."end" IS NULL OR k."end" <= tk.pos)""".replace("{W}", str(W)), REPAIR_CTES)
def wrong_words(c):
    return run_repair(c).wrong


CLEAN_SQL = """
SELECT f.id, f.resource_id, f.package_id, replace(f.text, 'er', 'e r') AS text,
  CASE WHEN f.text IS NOT NULL{only} THEN coalesce(k.text_clear, '') ELSE f.text_clear END AS text_clear
FROM fulltext f LEFT JOIN (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text_clear FROM kept GROUP BY doc_id) k ON k.doc_id = f.id"""
CLEAN_CTES = REPAIR_CTES | {"raw_tokens": TOKENS_SQL.replace(
    "SELECT doc_id, replace(text, 'er', 'e r') AS text FROM documents",
    "SELECT id AS doc_id, replace(text, 'er', 'e r') AS text FROM fulltext WHERE text IS NOT NULL")}


def _clean(c, mode):
    broken = c.fulltext.withColumn("text", F.replace("text", F.lit("er"), F.lit("e r")))
    return rp.clean_batch(broken, word_list(c), mode, S)


@query("clean_batch", CLEAN_SQL.replace("{only}", " AND f.text_clear IS NULL"), CLEAN_CTES)
def clean_batch(c):
    return _clean(c, "empty")


@query("clean_batch_all", CLEAN_SQL.replace("{only}", ""), CLEAN_CTES)
def clean_batch_all(c):
    return _clean(c, "all")
