"""Registered queries: outcome, write-back, batch run, index documents."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..functions.text import sql_quote
from ..operators import select
from ..operators.texttable import TextTable
from ..session import scratch_path, written
from . import pipeline as pl
from .params import MAX_SIZE, SETTINGS as S
from .q_more import MEMBER_TEXT, REDIRECT_PAGES, TREE, redirect_pages, sql_page_text, sql_redirect_target
from .q_repair import REPAIR_CTES, TOKENS_SQL, word_list
from .q_search import INDEX_SQL, POSTINGS_SQL, built_index
from .q_text import PYWS, sql_fulltext_url, sql_normalise, sql_normalise_url
from .registry import query

Q = sql_quote
PKG_BL = "(" + ", ".join(Q(p) for p in S.package_blacklist) + ")"

ARCHIVE_TEXT_SQL = f"""
SELECT concat('r', root_id) AS resource_id,
  string_agg(path || chr(10), '' ORDER BY depth, lineage, seq) || string_agg(t, chr(10) ORDER BY depth, lineage, seq) AS archive_raw
FROM (SELECT *, {MEMBER_TEXT} AS t FROM am) x WHERE length(t) > 0 GROUP BY root_id"""

IS_ERROR_PAGE = ("(contains(d.text, '404 - File or directory not found') OR contains(d.text, '404 Not Found   Not Found') "
                 "OR contains(d.text, 'NOT_AVAILABLE') OR contains(d.text, 'The page cannot be displayed because') "
                 "OR contains(d.text, 'The requested URL could not be retrieved'))")
BLANK = "regexp_matches(coalesce({x}, ''), '^{ws}*$')".replace("{ws}", PYWS)


def _outcome_sql(select_pkgs: str, fetched_filter: str = "true", pages: bool = False) -> str:
    """``pages``: a URL that ends in .html is read from ``page_raw``, where
    that has the resource."""
    fetched = f"SELECT concat('r', doc_id) AS resource_id, text FROM documents WHERE {fetched_filter}"
    if pages:
        fetched = f"""SELECT f.resource_id, CASE WHEN x.resource_id IS NOT NULL AND ends_with(lower(y.text_url), '.html')
      THEN x.page_raw ELSE f.text END AS text
    FROM ({fetched}) f JOIN urls y ON y.resource_id = f.resource_id LEFT JOIN page_raw x ON x.resource_id = f.resource_id"""
    raw = f"regexp_replace(d.text, '^{PYWS}+|{PYWS}+$', '', 'g')"
    got = f"""CASE WHEN contains(u.text_url, 'alkis_liegenschaftskarte') THEN NULL
      WHEN ends_with(lower(u.text_url), 'gml') THEN ''
      WHEN r.package_id IN {PKG_BL} THEN ''
      WHEN {BLANK.replace('{x}', 'u.text_url')} THEN ''
      WHEN coalesce(TRY_CAST(r.file_size AS BIGINT) > {S.max_file_size}, false) THEN ''
      WHEN contains(lower(u.norm_url), '.zip') OR contains(lower(u.norm_url), '.rar') THEN coalesce(a.archive_raw, 'ERROR_FULLTEXT')
      WHEN d.text IS NULL THEN 'ERROR_FULLTEXT'
      WHEN {IS_ERROR_PAGE} THEN 'ERROR_FULLTEXT'
      WHEN ends_with(lower(u.text_url), '.csv') THEN {sql_normalise(raw, True)}
      ELSE {sql_normalise(raw)} END"""
    return TREE + f""",
urls AS (SELECT resource_id, text_url, {sql_normalise_url('text_url')} AS norm_url FROM ({sql_fulltext_url()}) f),
arch AS ({ARCHIVE_TEXT_SQL}),
sel AS ({select_pkgs}),
o AS (
  SELECT r.resource_id, r.package_id, u.text_url, {got} AS got
  FROM resource r JOIN urls u ON u.resource_id = r.resource_id
  LEFT JOIN ({fetched}) d ON d.resource_id = r.resource_id
  LEFT JOIN arch a ON a.resource_id = r.resource_id
  WHERE r.package_id IN (SELECT package_id FROM sel)),
outcome AS (
  SELECT resource_id, package_id,
    CASE WHEN contains(text_url, 'alkis_liegenschaftskarte') OR {BLANK.replace('{x}', 'got')} THEN 'NOT_AVAILABLE'
      ELSE got END AS text, CAST(NULL AS VARCHAR) AS text_clear FROM o)
"""


SEL_RETRY = f"""
SELECT DISTINCT package_id FROM fulltext WHERE trim(text) IN ('UNPROCESSED_FULLTEXT', 'ERROR_FULLTEXT',
 'Es ist ein interner Serverfehler aufgetreten.', 'Wrong parameter set', 'Wrong parameter set!',
 'Portlet Application ingrid-portal-apps not available',
 '404 Not Found   Not Found  The requested URL was not found on this server.',
 'Service Unavailable  Service Unavailable   HTTP Error 503. The service is unavailable.')
UNION ALL SELECT DISTINCT package_id FROM fulltext WHERE length(text) > {MAX_SIZE}"""


def _selection(c):
    return select.work_selection(c.fulltext, retry=True, max_size=MAX_SIZE).distinct()


@query("outcome", _outcome_sql("SELECT package_id FROM package") + "SELECT * FROM outcome")
def outcome(c):
    return pl.outcome(c.resource, c.package, c.harvest, pl.fetched_texts(c.raw("documents")), c.members, S)


@query("outcome_default_error",
       _outcome_sql(SEL_RETRY, "doc_id % 6 <> 5") + "SELECT * FROM outcome")
def outcome_default_error(c):
    """A fetch that produced nothing (here: every sixth document is
    missing from the fetch output) leaves ERROR_FULLTEXT."""
    res = c.resource.join(_selection(c), "package_id", "left_semi")
    fetched = pl.fetched_texts(c.raw("documents").filter(F.col("doc_id") % 6 != 5))
    return pl.outcome(res, c.package, c.harvest, fetched, c.members, S)


APPLY_SQL = f"""
processed AS (SELECT resource_id FROM outcome),
keep AS (
  SELECT * FROM (
    SELECT f.*, row_number() OVER (PARTITION BY f.resource_id ORDER BY
      CASE WHEN f.text IN ('UNPROCESSED_FULLTEXT', 'ERROR_FULLTEXT') THEN 1 ELSE 0 END, f.id) AS rn
    FROM fulltext f WHERE f.resource_id IN (SELECT resource_id FROM processed)) x WHERE rn = 1)
SELECT id, resource_id, package_id, text, text_clear FROM fulltext
WHERE resource_id NOT IN (SELECT resource_id FROM processed)
UNION ALL
SELECT k.id, k.resource_id, k.package_id, o.text, o.text_clear FROM keep k JOIN outcome o ON o.resource_id = k.resource_id
UNION ALL
SELECT concat(o.resource_id, '-new'), o.resource_id, o.package_id, o.text, o.text_clear FROM outcome o
WHERE o.resource_id NOT IN (SELECT resource_id FROM fulltext)"""


def stored_table(c, buckets: int = 16) -> TextTable:
    """A stored copy of the text table for a query to work on."""
    table = TextTable(c.spark, scratch_path(c.spark, "fulltext"), buckets)
    table.create(c.fulltext)
    return table


@query("apply_outcome", _outcome_sql(SEL_RETRY) + ", " + APPLY_SQL)
def apply_outcome(c):
    """The outcome of the selected packages written to the stored table,
    which is read back."""
    res = c.resource.join(_selection(c), "package_id", "left_semi")
    o = written(pl.outcome(res, c.package, c.harvest, pl.fetched_texts(c.raw("documents")), c.members, S), "outcome")
    table = stored_table(c)
    table.apply(o)
    return table.read()


# The fetched pages: r<n> is read from page n, whose script may send on.
PAGE_CTES = {"rpages": REDIRECT_PAGES, "page_raw": f"""
SELECT concat('r', s.page_id) AS resource_id,
  CASE WHEN s.target = s.url THEN coalesce({sql_page_text('s.html')}, '')
       WHEN d.page_id IS NOT NULL THEN coalesce({sql_page_text('d.html')}, '') END AS page_raw
FROM (SELECT page_id, url, html, {sql_redirect_target('url', 'html')} AS target FROM rpages) s
LEFT JOIN (SELECT * FROM rpages WHERE page_id IN (SELECT min(page_id) FROM rpages GROUP BY url)) d ON d.url = s.target"""}


def fetched_pages(c):
    return redirect_pages(c).select(F.concat(F.lit("r"), "page_id").alias("resource_id"), "page_id", "url", "html")


def _process_sql(tail: str) -> str:
    """The outcome, the repair over its cleanable texts, the write-back
    (``after``: the table after the run)."""
    repair = "".join(f",\n{name} AS ({sql})" for name, sql in (REPAIR_CTES | {"raw_tokens": TOKENS_SQL.replace(
        "SELECT doc_id, replace(text, 'er', 'e r') AS text FROM documents", "SELECT doc_id, text FROM todo")}).items())
    apply = APPLY_SQL.replace("keep AS", "winner AS").replace("FROM keep k", "FROM winner k").replace("outcome", "cleaned")
    head, _, rows = apply.partition("SELECT id, resource_id, package_id, text, text_clear FROM fulltext")
    return _outcome_sql(SEL_RETRY, pages=True) + f""",
src AS (SELECT package_id, arg_min(source_title, (guid, source_title)) AS source_title
        FROM harvest WHERE current GROUP BY package_id),
todo AS (
  SELECT u.resource_id AS doc_id, u.text FROM outcome u JOIN resource r ON r.resource_id = u.resource_id
  JOIN src s ON s.package_id = r.package_id
  WHERE s.source_title IN ('source1', 'source2') AND u.text NOT IN ('NOT_AVAILABLE', 'UNPROCESSED_FULLTEXT', 'ERROR_FULLTEXT')
    AND (ends_with(lower(r.url), 'rar') OR ends_with(lower(r.url), 'zip') OR ends_with(lower(r.url), 'pdf'))){repair},
tcl AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text_clear FROM kept GROUP BY doc_id),
cleaned AS (
  SELECT u.resource_id, u.package_id, u.text,
    CASE WHEN u.text = 'NOT_AVAILABLE' THEN '' WHEN t.doc_id IS NOT NULL THEN coalesce(k.text_clear, '') END AS text_clear
  FROM outcome u LEFT JOIN todo t ON t.doc_id = u.resource_id LEFT JOIN tcl k ON k.doc_id = u.resource_id),
{head}, after AS (SELECT id, resource_id, package_id, text, text_clear FROM fulltext{rows})
{tail}"""


def batch_run(c, index: bool = False) -> pl.Run:
    """B1 over the packages that need work, cleaning on, pages and redirects
    read; with ``index`` also the search index of before is brought up to date."""
    s = dataclasses.replace(S, clean_sources=("source1", "source2"))
    before = built_index(c) if index else None
    pages = written(fetched_pages(c), "pages", "zstd")      # they come from a join and are read three times
    return pl.process_packages(c, _selection(c), s, stored_table(c), do_clean=True, dictionary=word_list(c),
                               pages=pages, index=before)


@query("process_packages", _process_sql("SELECT * FROM after"), PAGE_CTES)
def process_packages(c):
    """B1: the stored text table after the run."""
    return batch_run(c).table.read()


@query("process_packages_documents", _process_sql(f"""
SELECT r.package_id, r.position, coalesce(w.text, '') AS text, coalesce(w.text_clear, '') AS text_clear
FROM resource r JOIN package p ON p.package_id = r.package_id LEFT JOIN after w ON w.resource_id = r.resource_id
WHERE p.type <> 'harvest' AND r.package_id NOT IN {PKG_BL} AND r.package_id IN (SELECT package_id FROM sel)"""), PAGE_CTES)
def process_packages_documents(c):
    """B1: the index documents (Q1) of the packages that were processed."""
    return _flat_documents(batch_run(c).documents)


@query("process_packages_index", _process_sql(
    POSTINGS_SQL.replace("FROM idx", f"FROM ({INDEX_SQL.replace('deduped', 'after')})")), PAGE_CTES)
def process_packages_index(c):
    """B1: the search index after the run's differences equals one that is
    built from the table it left."""
    return batch_run(c, index=True).index.postings()


@query("clean_eligible", """
WITH src AS (SELECT package_id, arg_min(source_title, (guid, source_title)) AS source_title
             FROM harvest WHERE current GROUP BY package_id)
SELECT r.package_id, r.resource_id, coalesce(s.source_title IN ('source1'), false) AS source_listed,
  (ends_with(lower(r.url), 'rar') OR ends_with(lower(r.url), 'zip') OR ends_with(lower(r.url), 'pdf')) AS url_cleanable,
  coalesce(s.source_title IN ('source1'), false) AND (ends_with(lower(r.url), 'rar') OR ends_with(lower(r.url), 'zip') OR ends_with(lower(r.url), 'pdf')) AS clean
FROM resource r LEFT JOIN src s ON s.package_id = r.package_id""")
def clean_eligible(c):
    from ..operators import assemble
    return assemble.clean_eligible(c.resource, c.harvest, S.clean_sources)


@query("index_document", f"""
WITH deduped AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY
    CASE WHEN text IN ('UNPROCESSED_FULLTEXT', 'ERROR_FULLTEXT') THEN 1 ELSE 0 END, id) AS rn FROM fulltext) x
  WHERE rn = 1)
SELECT r.package_id, r.position,
  CASE WHEN d.id IS NULL THEN '' ELSE d.text END AS text,
  coalesce(CASE WHEN d.id IS NULL THEN '' ELSE d.text_clear END, '') AS text_clear
FROM resource r JOIN package p ON p.package_id = r.package_id
LEFT JOIN deduped d ON d.package_id = r.package_id AND d.resource_id = r.resource_id
WHERE p.type <> 'harvest' AND r.package_id NOT IN {PKG_BL}""")
def index_document(c):
    return _flat_documents(pl.index_documents(c.package, c.resource, c.fulltext, S))


def _flat_documents(docs):
    return docs.select("package_id", F.posexplode(F.arrays_zip(
        F.col("res_fulltext").alias("text"), F.col("res_fulltext_clear").alias("text_clear"))).alias("position", "x")) \
        .select("package_id", F.col("position").cast("bigint").alias("position"), "x.text", "x.text_clear")


DICT_TYPE = ("struct<id:string,name:string,title:string,state:string,type:string,owner:bigint,num_resources:int,"
             "resources:array<struct<id:string,position:bigint,url:string,fulltext:string>>>")


@query("index_data_dict", """
SELECT p.package_id, d.kind, p.name, p.title, p.state, p.type, p.owner, r.resource_id AS id, r.position, r.url,
  CAST(NULL AS VARCHAR) AS fulltext,
  CASE WHEN d.kind = 'validated' THEN (SELECT count(*) FROM resource x WHERE x.package_id = p.package_id) END AS num_resources
FROM package p JOIN resource r ON r.package_id = p.package_id, (VALUES ('data'), ('validated')) d(kind)
WHERE p.type <> 'harvest'""")
def index_data_dict(c):
    """Q1: both JSON dictionaries, written out with the index documents and
    parsed back: whole packages, their resources without any text."""
    path = scratch_path(c.spark, "index")
    pl.write_index(pl.index_documents(c.package, c.resource, c.fulltext, S), path)
    docs = c.spark.read.schema("package_id string, data_dict string, validated_data_dict string").json(path)
    both = docs.select("package_id", F.explode(F.create_map(
        F.lit("data"), F.col("data_dict"), F.lit("validated"), F.col("validated_data_dict"))).alias("kind", "json"))
    d = both.select("package_id", "kind", F.from_json("json", DICT_TYPE).alias("d"))
    return d.select("package_id", "kind", "d.name", "d.title", "d.state", "d.type", "d.owner",
                    F.col("d.num_resources").cast("long").alias("num_resources"), F.explode("d.resources").alias("r")) \
            .select("package_id", "kind", "name", "title", "state", "type", "owner", "num_resources",
                    "r.id", "r.position", "r.url", "r.fulltext")
