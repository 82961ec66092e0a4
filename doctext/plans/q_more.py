"""Registered queries: archives, pages and redirects, failure ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import sql_quote
from ..operators import archive, ledger, select
from ..operators.keys import split_by_keys
from ..sources import pages as pg
from .params import MAX_SIZE, SETTINGS as S
from .q_state import ERR_SQL
from .q_text import PYWS, sql_normalise, sql_resolve
from .registry import query

Q = sql_quote
TREE = """
WITH RECURSIVE edges AS (SELECT DISTINCT archive_id, parent_id FROM members),
tree(archive_id, root_id, depth, lineage) AS (
  SELECT archive_id, archive_id, 0, [archive_id] FROM edges WHERE parent_id IS NULL
  UNION ALL
  SELECT e.archive_id, t.root_id, t.depth + 1, list_append(t.lineage, e.archive_id)
  FROM edges e JOIN tree t ON e.parent_id = t.archive_id),
am AS (
  SELECT t.root_id, t.depth, t.lineage, m.archive_id, m.seq, m.path, m.text
  FROM members m JOIN tree t ON t.archive_id = m.archive_id
  WHERE NOT ends_with(m.path, '/') AND NOT ends_with(lower(m.path), 'gml'))
"""


@query("archive_members", TREE + "SELECT root_id, depth, archive_id, seq, path FROM am")
def archive_members(c):
    return archive.archive_members(c.members, S.archive_blacklist) \
                  .select("root_id", "depth", "archive_id", "seq", "path")


STRIPPED = f"regexp_replace(text, '^{PYWS}+|{PYWS}+$', '', 'g')"
MEMBER_TEXT = f"CASE WHEN ends_with(lower(path), '.csv') THEN {sql_normalise(STRIPPED, True)} ELSE {sql_normalise(STRIPPED)} END"


@query("archive_text", TREE + f"""
SELECT root_id AS archive_id,
  string_agg(path || chr(10), '' ORDER BY depth, lineage, seq) || string_agg(t, chr(10) ORDER BY depth, lineage, seq) AS text
FROM (SELECT *, {MEMBER_TEXT} AS t FROM am) x WHERE length(t) > 0 GROUP BY root_id""")
def archive_text(c):
    return archive.archive_text(c.members, S.archive_blacklist)


@query("archive_member", """
SELECT r.archive_id, r.path, m.text, (m.archive_id IS NOT NULL) AS found
FROM (SELECT DISTINCT archive_id, concat('a', archive_id, '/0.txt') AS path FROM members) r
LEFT JOIN members m ON m.archive_id = r.archive_id AND m.path = r.path""")
def archive_member(c):
    req = c.members.select("archive_id", F.concat(F.lit("a"), "archive_id", F.lit("/0.txt")).alias("path")).distinct()
    return archive.archive_member(c.members, req)


# ---- pages --------------------------------------------------------------
WS = "[\\t\\n\\x0B\\f\\r ]"


def sql_page_text(x: str) -> str:
    x = f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    for ent, ch in [*pg.ENTITIES.items(), ("#39", "'"), ("amp", "&")]:
        x = f"replace({x}, '&{ent};', {Q(ch)})"
    x = f"regexp_replace({x}, '{WS}+', ' ', 'g')"
    x = f"regexp_replace({x}, '^ | $', '', 'g')"
    return f"nullif({x}, '')"


@query("page_text", f"SELECT page_id, {sql_page_text('html')} AS text FROM pages")
def page_text(c):
    return c.pages.select("page_id", pg.page_text("html").alias("text"))


# Redirect fixtures: every fifth page's first script sends to the next
# page (absolute), the next fifth to a relative path, the next to a
# parent-relative path.
REDIRECT_PAGES = """
SELECT p.page_id, p.url, CASE
  WHEN p.page_id % 5 = 0 AND q.url IS NOT NULL THEN replace(p.html, '<script>', concat('<script>window.location.replace(''', q.url, ''');'))
  WHEN p.page_id % 5 = 1 THEN replace(p.html, '<script>', concat('<script>window.location.assign(''./p', p.page_id, '.html'');'))
  WHEN p.page_id % 5 = 2 THEN replace(p.html, '<script>', '<script>window.location.href=''../up.html'';')
  ELSE p.html END AS html
FROM pages p LEFT JOIN pages q ON q.page_id = p.page_id + 1"""


def redirect_pages(c):
    p = c.pages
    q = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    m = F.col("page_id") % 5
    # Every fifth page takes the next one's URL; of the others only those move
    # that the join repeats.
    takes = F.coalesce(m == 0, F.lit(False))
    near, away = split_by_keys(p, q.groupBy("page_id").count().where("count > 1"), "page_id")
    j = p.where(takes).unionByName(near.where(~takes)).join(q, "page_id", "left").unionByName(
        away.where(~takes).withColumn("next_url", F.lit(None).cast("string")))
    html = (F.when((m == 0) & F.col("next_url").isNotNull(),
                   F.replace("html", F.lit("<script>"),
                             F.concat(F.lit("<script>window.location.replace('"), "next_url", F.lit("');"))))
             .when(m == 1, F.replace("html", F.lit("<script>"),
                                     F.concat(F.lit("<script>window.location.assign('./p"), "page_id",
                                              F.lit(".html');"))))
             .when(m == 2, F.replace("html", F.lit("<script>"),
                                     F.lit("<script>window.location.href='../up.html';")))
             .otherwise(F.col("html")))
    return j.select("page_id", "url", html.alias("html"))


def sql_redirect_target(url: str, html: str) -> str:
    js = f"regexp_extract({html}, '(?is)<script\\b[^>]*>(.*?)</script>', 1)"
    at = f"instr({js}, 'window.location.')"
    sub = f"substring({js}, {at})"
    a, b = f"instr({sub}, '(')", f"instr({sub}, ')')"
    end = f"(CASE WHEN {b} > 0 THEN {b} - 1 ELSE length({sub}) - 1 END)"
    arg = f"trim(substring({sub}, {a} + 1, greatest({end} - {a}, 0)), '''')"
    return (f"CASE WHEN {js} = '' OR {at} = 0 THEN {url} WHEN starts_with({arg}, 'http') THEN {arg} "
            f"WHEN starts_with({arg}, '.') THEN {sql_resolve(arg, url)} ELSE {url} END")


@query("redirect_target", f"SELECT page_id, {sql_redirect_target('url', 'html')} AS target FROM rpages",
       {"rpages": REDIRECT_PAGES})
def redirect_target(c):
    return redirect_pages(c).select("page_id", pg.redirect_target("url", "html").alias("target"))


@query("redirect_text", f"""
SELECT s.page_id, s.target, d.page_id AS target_id, {sql_page_text('d.html')} AS text
FROM (SELECT page_id, {sql_redirect_target('url', 'html')} AS target FROM rpages) s
LEFT JOIN (SELECT * FROM rpages WHERE page_id IN (SELECT min(page_id) FROM rpages GROUP BY url)) d ON d.url = s.target""",
       {"rpages": REDIRECT_PAGES})
def redirect_text(c):
    return pg.redirect_text(redirect_pages(c))


# ---- ledger -------------------------------------------------------------
SUMMARY = """
WITH s AS (
  SELECT package_id, max(attempt_no) AS last_no,
    max(CASE WHEN NOT failed THEN attempt_no END) AS last_ok,
    arg_max(failed, attempt_no) AS last_failed, arg_max(ended_at, attempt_no) AS last_at,
    arg_max(error_class, attempt_no) AS last_class
  FROM attempts GROUP BY package_id)
"""


@query("retry_candidates", SUMMARY + """
SELECT package_id, last_no - coalesce(last_ok, 0) AS retry FROM s
WHERE last_failed AND last_no - coalesce(last_ok, 0) <= 5 AND last_class IN ('error')""")
def retry_candidates(c):
    return ledger.retry_candidates(c.attempts, error_classes=("error",))


@query("failed_packages", SUMMARY + """
SELECT package_id, last_no AS attempt_no, last_at AS ended_at, last_class AS error_class FROM s WHERE last_failed""")
def failed_packages(c):
    return ledger.failed_packages(c.attempts)


@query("failed_count", SUMMARY + "SELECT count(*) AS n FROM s WHERE last_failed")
def failed_count(c):
    return ledger.failed_count(c.attempts)


@query("failure_report", SUMMARY + """
SELECT package_id, 1 AS line_no,
  format('Job with args [''{}''] failed at {} with error:', package_id, strftime(last_at, '%Y-%m-%d %H:%M:%S')) AS line
FROM s WHERE last_failed
UNION ALL
SELECT package_id, 2, last_class FROM s WHERE last_failed
UNION ALL
SELECT NULL, 1, 'No failed jobs found.' FROM (SELECT count(*) AS n FROM s WHERE last_failed) z WHERE n = 0""")
def failure_report(c):
    return ledger.failure_report(c.attempts)


@query("requeue", SUMMARY + f"""
SELECT package_id FROM s WHERE last_failed
UNION
SELECT package_id FROM (
  SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN {ERR_SQL}
  UNION ALL SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}) w""")
def requeue(c):
    sel = select.work_selection(c.fulltext, retry=True, max_size=MAX_SIZE)
    return ledger.requeue(c.attempts, sel)


@query("requeue_report", SUMMARY + """
SELECT format('{} have been requeued.', count(*)) AS message FROM s WHERE last_failed""")
def requeue_report(c):
    return ledger.requeue_report(c.attempts)
