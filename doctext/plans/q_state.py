"""Registered queries: scans, selections, counts, J1 and state writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import sql_quote
from ..operators import assemble, select, state
from ..schema import ERROR_PHRASES
from .params import CUT_CHARS, MAX_SIZE, MODIFIED_SINCE, OVERSIZE, PACKAGE_ID, READ_LIMIT, RESOURCE_ID, SETTINGS as S
from .registry import query

ERR_SQL = "(" + ", ".join(sql_quote(p) for p in ERROR_PHRASES) + ")"
FMT_SQL = "(" + ", ".join(sql_quote(p) for p in S.resource_format_blacklist) + ")"
PKG_BL_SQL = "(" + ", ".join(sql_quote(p) for p in S.package_blacklist) + ")"

# W4 in SQL: one row per resource, processed rows first, then smallest id.
DEDUPED_SQL = """
SELECT id, resource_id, package_id, text, text_clear FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY
    CASE WHEN text IN ('UNPROCESSED_FULLTEXT', 'ERROR_FULLTEXT') THEN 1 ELSE 0 END, id) AS rn
  FROM fulltext) x WHERE rn = 1
"""


@query("scan_fulltext", "SELECT id, resource_id, package_id, text, text_clear FROM fulltext")
def scan_fulltext(c):
    return c.fulltext


@query("all_package_ids", "SELECT DISTINCT package_id FROM fulltext")
def all_package_ids(c):
    return select.all_package_ids(c.fulltext)


@query("packages_with_text",
       "SELECT DISTINCT package_id FROM fulltext WHERE text = 'UNPROCESSED_FULLTEXT'")
def packages_with_text(c):
    return select.packages_with_text(c.fulltext, "UNPROCESSED_FULLTEXT")


@query("packages_with_any_text",
       "SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN ('Wrong parameter set', 'NOT_AVAILABLE')")
def packages_with_any_text(c):
    return select.packages_with_any_text(c.fulltext, ["Wrong parameter set", "NOT_AVAILABLE"])


@query("packages_with_error", f"SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN {ERR_SQL}")
def packages_with_error(c):
    return select.packages_with_error(c.fulltext)


@query("packages_min_size", f"SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}")
def packages_min_size(c):
    return select.packages_min_size(c.fulltext, MAX_SIZE)


@query("first_fulltext", """
SELECT resource_id, id, package_id, text, text_clear FROM (
  SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY id) AS rn FROM fulltext) x
WHERE rn = 1""")
def first_fulltext(c):
    return select.first_fulltext(c.fulltext)


@query("fulltexts_of_resource", f"SELECT * FROM fulltext WHERE resource_id = '{RESOURCE_ID}'")
def fulltexts_of_resource(c):
    return select.fulltexts_of_resource(c.fulltext, RESOURCE_ID)


@query("error_count", f"SELECT count(DISTINCT package_id) AS n FROM fulltext WHERE text IN {ERR_SQL}")
def error_count(c):
    return select.error_count(c.fulltext)


@query("unprocessed_count",
       "SELECT count(DISTINCT package_id) AS n FROM fulltext WHERE text = 'UNPROCESSED_FULLTEXT'")
def unprocessed_count(c):
    return select.unprocessed_count(c.fulltext)


@query("unavailable_count",
       "SELECT count(DISTINCT package_id) AS n FROM fulltext WHERE text = 'NOT_AVAILABLE'")
def unavailable_count(c):
    return select.unavailable_count(c.fulltext)


@query("packages_modified_since",
       f"SELECT package_id FROM package WHERE metadata_modified > TIMESTAMP '{MODIFIED_SINCE}'")
def packages_modified_since(c):
    return select.packages_modified_since(c.package, MODIFIED_SINCE)


@query("work_selection_all", f"""
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext) a
UNION ALL
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}) b""")
def work_selection_all(c):
    return select.work_selection(c.fulltext, force_all=True, max_size=MAX_SIZE)


@query("work_selection_retry", f"""
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN {ERR_SQL}) a
UNION ALL
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}) b""")
def work_selection_retry(c):
    return select.work_selection(c.fulltext, retry=True, max_size=MAX_SIZE)


@query("work_selection_unprocessed", f"""
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE text = 'UNPROCESSED_FULLTEXT') a
UNION ALL
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}) b""")
def work_selection_unprocessed(c):
    return select.work_selection(c.fulltext, retry=False, max_size=MAX_SIZE)


@query("work_selection_capped", f"""
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN {ERR_SQL}) a
UNION ALL
SELECT * FROM (SELECT DISTINCT package_id FROM fulltext WHERE length(text) > 20) b""")
def work_selection_capped(c):
    return select.work_selection_capped(c.fulltext, max_chars=0)


@query("work_selection_one", f"SELECT DISTINCT package_id FROM fulltext WHERE package_id = '{PACKAGE_ID}'")
def work_selection_one(c):
    """P13, the run of a single package."""
    return select.work_selection_capped(c.fulltext, package_id=PACKAGE_ID)


@query("clean_all_ids", "SELECT resource_id FROM fulltext")
def clean_all_ids(c):
    return select.clean_all_ids(c.fulltext)


@query("clean_pending_ids", "SELECT resource_id FROM fulltext WHERE text_clear IS NULL")
def clean_pending_ids(c):
    return select.clean_pending_ids(c.fulltext)


@query("clean_one", f"SELECT resource_id FROM fulltext WHERE resource_id = '{RESOURCE_ID}'")
def clean_one(c):
    return select.clean_one(c.fulltext, RESOURCE_ID)


@query("is_archive_url", """
SELECT resource_id, (contains(lower(url), '.zip') OR contains(lower(url), '.rar')) AS is_archive
FROM resource""")
def is_archive_url(c):
    return c.resource.select("resource_id", select.is_archive_url("url").alias("is_archive"))


@query("is_archive_name", """
SELECT archive_id, seq, (ends_with(lower(path), 'zip') OR ends_with(lower(path), 'rar')) AS is_archive,
  ends_with(lower(url), 'zip') AS url_is_zip
FROM members m JOIN resource r ON r.resource_id = concat('r', m.archive_id)""")
def is_archive_name(c):
    r = c.resource.select(F.col("resource_id"), "url")
    m = c.members.withColumn("resource_id", F.concat(F.lit("r"), F.col("archive_id")))
    return m.join(r, "resource_id").select(
        "archive_id", "seq", select.is_archive_name("path").alias("is_archive"),
        F.lower("url").endswith("zip").alias("url_is_zip"))


@query("format_blacklist", """
SELECT resource_id, ends_with(lower(url), 'gml') AS blacklisted FROM resource""")
def format_blacklist(c):
    return c.resource.select("resource_id",
                             select.has_blacklisted_suffix("url", S.format_blacklist).alias("blacklisted"))


@query("package_blacklist", f"""
SELECT package_id, package_id IN {PKG_BL_SQL} AS blacklisted FROM package""")
def package_blacklist(c):
    return c.package.select("package_id", select.in_list("package_id", S.package_blacklist).alias("blacklisted"))


@query("oversize", f"""
SELECT resource_id, coalesce(TRY_CAST(file_size AS BIGINT) > {OVERSIZE}, false) AS oversize FROM resource""")
def oversize(c):
    return c.resource.select("resource_id", select.is_oversize("file_size", OVERSIZE).alias("oversize"))


# ---------------------------------------------------------------- J1 ----
J1_SQL = f"""
SELECT r.package_id, r.resource_id, r.position,
  CASE WHEN lower(r.format) IN {FMT_SQL} OR d.id IS NULL THEN '' ELSE {{t}} END AS text,
  CASE WHEN lower(r.format) IN {FMT_SQL} OR d.id IS NULL THEN '' ELSE {{tc}} END AS text_clear
FROM resource r LEFT JOIN deduped d ON d.package_id = r.package_id AND d.resource_id = r.resource_id
WHERE r.package_id NOT IN {PKG_BL_SQL}"""


# The same without a format blacklist: what views and the index show.
J1_ALL_SQL = J1_SQL.replace(f"lower(r.format) IN {FMT_SQL} OR ", "")


@query("attach_fulltext", J1_SQL.format(t="d.text", tc="d.text_clear"), {"deduped": DEDUPED_SQL})
def attach_fulltext(c):
    return assemble.attach_fulltext(c.resource, c.fulltext, S.resource_format_blacklist, 0,
                                    S.package_blacklist)


@query("attach_fulltext_limited",
       J1_SQL.format(t=f"left(d.text, {READ_LIMIT})", tc=f"left(d.text_clear, {READ_LIMIT})"),
       {"deduped": DEDUPED_SQL})
def attach_fulltext_limited(c):
    return assemble.attach_fulltext(c.resource, c.fulltext, S.resource_format_blacklist,
                                    READ_LIMIT, S.package_blacklist)


@query("package_texts", f"""
WITH j1 AS ({J1_ALL_SQL.format(t="d.text", tc="d.text_clear")}),
err AS (SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN {ERR_SQL})
SELECT j1.*, (err.package_id IS NOT NULL) AS in_error
FROM j1 LEFT JOIN err ON err.package_id = j1.package_id""", {"deduped": DEDUPED_SQL})
def package_texts(c):
    """Flagship: each package's resource texts (blacklists applied)
    with the package's error flag."""
    j1 = assemble.attach_fulltext(c.resource, c.fulltext, (), 0, S.package_blacklist)
    err = select.packages_with_error(c.fulltext).withColumn("in_error", F.lit(True))
    return (j1.join(err, "package_id", "left")
              .withColumn("in_error", F.coalesce(F.col("in_error"), F.lit(False))))


# ---------------------------------------------------------------- W* ----
@query("dedupe_resource", DEDUPED_SQL)
def dedupe_resource(c):
    return state.dedupe_resource(c.fulltext)


@query("init_unprocessed", f"""
WITH targets AS (
  SELECT r.resource_id, r.package_id FROM resource r
  WHERE r.package_id IN (SELECT package_id FROM package WHERE metadata_modified > TIMESTAMP '{MODIFIED_SINCE}')),
firsts AS (SELECT resource_id, min(id) AS id FROM fulltext
           WHERE resource_id IN (SELECT resource_id FROM targets) GROUP BY resource_id)
SELECT f.id, f.resource_id, f.package_id,
  CASE WHEN x.id IS NOT NULL THEN 'UNPROCESSED_FULLTEXT' ELSE f.text END AS text,
  CASE WHEN x.id IS NOT NULL THEN NULL ELSE f.text_clear END AS text_clear
FROM fulltext f LEFT JOIN firsts x ON x.resource_id = f.resource_id AND x.id = f.id
UNION ALL
SELECT concat(t.resource_id, '-new'), t.resource_id, t.package_id, 'UNPROCESSED_FULLTEXT', NULL
FROM targets t WHERE t.resource_id NOT IN (SELECT resource_id FROM fulltext)""")
def init_unprocessed(c):
    ids = select.packages_modified_since(c.package, MODIFIED_SINCE)
    return state.init_unprocessed(c.fulltext, c.resource, ids, check_exist=True)


@query("init_unprocessed_insert_all", """
SELECT id, resource_id, package_id, text, text_clear FROM fulltext
UNION ALL
SELECT concat(resource_id, '-new'), resource_id, package_id, 'UNPROCESSED_FULLTEXT', NULL FROM resource""")
def init_unprocessed_insert_all(c):
    ids = select.packages_modified_since(c.package, None)
    return state.init_unprocessed(c.fulltext, c.resource, ids, check_exist=False)


@query("empty_to_unavailable", r"""
SELECT resource_id, position,
  CASE WHEN regexp_matches(coalesce(text, ''), '^\s*$') THEN 'NOT_AVAILABLE' ELSE text END AS text
FROM incoming""")
def empty_to_unavailable(c):
    return c.incoming.select("resource_id", "position", state.empty_to_unavailable("text").alias("text"))


MERGE_SQL = r"""
WITH batch AS (
  SELECT b.package_id, p.state AS pstate FROM (SELECT DISTINCT package_id FROM incoming) b
  LEFT JOIN package p ON p.package_id = b.package_id),
new AS (SELECT package_id, resource_id,
  CASE WHEN regexp_matches(coalesce(text, ''), '^\s*$') THEN 'NOT_AVAILABLE' ELSE text END AS new_text
  FROM incoming),
j AS (
  SELECT o.id, coalesce(o.resource_id, n.resource_id) AS resource_id,
    coalesce(o.package_id, n.package_id) AS package_id, o.text, o.text_clear, n.new_text
  FROM fulltext o FULL OUTER JOIN new n ON o.package_id = n.package_id AND o.resource_id = n.resource_id),
a AS (
  SELECT j.*, CASE WHEN b.package_id IS NULL THEN 'keep'
    WHEN b.pstate = 'deleted' AND j.id IS NOT NULL THEN 'delete'
    WHEN b.pstate = 'deleted' THEN 'skip'
    WHEN j.id IS NULL THEN 'insert'
    WHEN j.new_text IS NULL THEN 'delete'
    ELSE 'update' END AS action
  FROM j LEFT JOIN batch b ON b.package_id = j.package_id)
SELECT coalesce(id, concat(resource_id, '-new')) AS id, resource_id, package_id, action,
  CASE WHEN action IN ('insert', 'update') THEN new_text ELSE text END AS text,
  CASE WHEN action IN ('insert', 'update') THEN NULL ELSE text_clear END AS text_clear
FROM a"""


@query("merge_actions", MERGE_SQL)
def merge_actions(c):
    return state.merge_actions(c.fulltext, c.incoming, c.package)


@query("merge_result", f"""
WITH m AS ({MERGE_SQL})
SELECT id, resource_id, package_id, text, text_clear FROM m WHERE action IN ('keep', 'update', 'insert')""")
def merge_result(c):
    return state.merge_result(c.fulltext, c.incoming, c.package)


@query("cascade_delete", """
SELECT f.* FROM fulltext f
WHERE EXISTS (SELECT 1 FROM resource r WHERE r.resource_id = f.resource_id AND r.package_id = f.package_id)
  AND EXISTS (SELECT 1 FROM package p WHERE p.package_id = f.package_id)""")
def cascade_delete(c):
    live = c.resource.join(c.package.select("package_id"), "package_id", "left_semi")
    return state.cascade_delete(c.fulltext, live)


@query("truncate", f"""
SELECT id, left(text, {CUT_CHARS}) AS text, left(text_clear, {CUT_CHARS}) AS text_clear FROM fulltext""")
def truncate(c):
    return state.truncate_both(c.fulltext, CUT_CHARS).select("id", "text", "text_clear")
