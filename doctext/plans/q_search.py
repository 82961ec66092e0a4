"""Registered queries: search (Q2-Q7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assemble, select
from ..operators import search as sr
from ..operators.index import SearchIndex, listed_texts, text_bytes
from ..session import scratch_path
from .params import SETTINGS as S
from .q_state import DEDUPED_SQL
from .registry import query

ALL_TERMS = ("the", "and")
ANY_TERMS = ("der", "le", "the", "la")
ANY_MIN = 2
START, ROWS = 10, 20

# Index texts: every resource text of the non-harvest packages (J1 without
# a read limit), tokenised into lower-case letter/digit runs.
INDEX_SQL = f"""
SELECT r.package_id, coalesce(d.text, '') AS text
FROM resource r JOIN package p ON p.package_id = r.package_id
LEFT JOIN deduped d ON d.package_id = r.package_id AND d.resource_id = r.resource_id
WHERE p.type <> 'harvest' AND r.package_id NOT IN ('p3', 'p10')"""

POSTINGS_SQL = """
SELECT term, package_id, count(*) AS tf FROM (
  SELECT package_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{Nd}]+'), lambda t: t <> '')) AS term
  FROM idx) x GROUP BY term, package_id"""

CTES = {"deduped": DEDUPED_SQL, "idx": INDEX_SQL, "post": POSTINGS_SQL}


def _q(ts):
    return "(" + ", ".join(f"'{t}'" for t in ts) + ")"


def MATCH_SQL(ts, need):
    return f"""SELECT package_id, count(DISTINCT term) AS matched_terms, sum(tf) AS tf FROM post
WHERE term IN {_q(ts)} GROUP BY package_id HAVING count(DISTINCT term) >= {need}"""


def SCORE_SQL(ts, need):
    return f"""
WITH m AS ({MATCH_SQL(ts, need)}),
dl AS (SELECT package_id, sum(tf) AS dl FROM post GROUP BY package_id),
st AS (SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM dl),
df AS (SELECT term, count(*) AS df FROM post WHERE term IN {_q(ts)} GROUP BY term),
sc AS (
  SELECT p.package_id, (sum(ln(1 + (st.n_docs - df.df + 0.5) / (df.df + 0.5)) * p.tf * 2.2 /
    (p.tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / st.avgdl)))) AS score
  FROM post p JOIN df ON df.term = p.term JOIN dl ON dl.package_id = p.package_id, st
  WHERE p.term IN {_q(ts)} AND p.package_id IN (SELECT package_id FROM m) GROUP BY p.package_id)
SELECT m.*, sc.score, pk.metadata_modified FROM m JOIN sc ON sc.package_id = m.package_id
JOIN package pk ON pk.package_id = m.package_id"""


def index_texts(c, size: int):
    """Texts of the listed resources; one without a text has no postings."""
    pk = c.package.filter((F.col("type") != "harvest") & ~select.in_list("package_id", S.package_blacklist))
    res = c.resource.join(pk.select("package_id"), "package_id", "left_semi")
    return listed_texts(c.fulltext, res, size)


def built_index(c) -> SearchIndex:
    """An index of the texts as they are.  All texts' bytes, read without a
    join, are size enough for the layout."""
    size = text_bytes(c.fulltext)
    return SearchIndex.build(index_texts(c, size), scratch_path(c.spark, "index"), size=size)


#: Folder of the stored index of each application and data folder.
_STORED: dict[tuple[str, str], str] = {}


def stored_index(c) -> SearchIndex:
    """The index of the texts as they are, built at its first use and read by
    every search after that."""
    key = (c.spark.sparkContext.applicationId, c.sf_dir)
    if key not in _STORED:
        _STORED[key] = built_index(c).root
    return SearchIndex(c.spark, _STORED[key])


@query("postings", "SELECT term, package_id, tf FROM post", CTES)
def postings(c):
    return stored_index(c).postings()


@query("search_all", MATCH_SQL(ALL_TERMS, len(ALL_TERMS)), CTES)
def search_all(c):
    return stored_index(c).match(ALL_TERMS)


@query("search_any", MATCH_SQL(ANY_TERMS, ANY_MIN), CTES)
def search_any(c):
    return stored_index(c).match(ANY_TERMS, ANY_MIN)


@query("search_filtered", f"""
SELECT m.* FROM ({MATCH_SQL(ANY_TERMS, ANY_MIN)}) m JOIN package p ON p.package_id = m.package_id
WHERE p.state = 'active' AND p.owner < 75""", CTES)
def search_filtered(c):
    m = stored_index(c).match(ANY_TERMS, ANY_MIN)
    return sr.filtered(m, c.package, (F.col("state") == "active") & (F.col("owner") < 75))


def _ranked(c, ts=ANY_TERMS, need=ANY_MIN):
    return sr.ranked(stored_index(c).bm25(ts, need), c.package)


@query("search_ranked", f"""
SELECT s.* REPLACE (round(s.score, 3) AS score) FROM ({SCORE_SQL(ANY_TERMS, ANY_MIN)}) s
ORDER BY s.score DESC, s.metadata_modified DESC, s.package_id""", CTES)
def search_ranked(c):
    """Every match in the default order (by the unrounded score)."""
    return _ranked(c).withColumn("score", F.round("score", 3))


@query("search_page", f"""
SELECT * REPLACE (round(score, 3) AS score) FROM (SELECT s.*, row_number() OVER (ORDER BY score DESC, metadata_modified DESC, package_id) AS rank
  FROM ({SCORE_SQL(ANY_TERMS, ANY_MIN)}) s) x WHERE rank > {START} AND rank <= {START + ROWS}""", CTES)
def search_page(c):
    return sr.page(_ranked(c), START, ROWS).withColumn("score", F.round("score", 3))


@query("search_count", f"SELECT count(*) AS count FROM ({MATCH_SQL(ANY_TERMS, ANY_MIN)}) m", CTES)
def search_count(c):
    return sr.count(stored_index(c).match(ANY_TERMS, ANY_MIN))


FIELDS_SQL = """
SELECT package_id, 'type' AS field, type AS value FROM package
UNION ALL SELECT package_id, 'state', state FROM package
UNION ALL SELECT DISTINCT package_id, 'res_format', format FROM resource"""


def facet_fields(c):
    p = c.package.select("package_id", F.explode(F.array(
        F.struct(F.lit("type").alias("field"), F.col("type").alias("value")),
        F.struct(F.lit("state").alias("field"), F.col("state").alias("value")))).alias("f")) \
        .select("package_id", "f.field", "f.value")
    r = c.resource.select("package_id", F.lit("res_format").alias("field"), F.col("format").alias("value")).distinct()
    return p.unionByName(r)


def FACETS_SQL(limit, mincount=1):
    lim = f"WHERE rk <= {limit}" if limit >= 0 else ""
    return f"""
SELECT field, value, count FROM (
  SELECT field, value, count, row_number() OVER (PARTITION BY field ORDER BY count DESC, value) AS rk FROM (
    SELECT f.field, f.value, count(DISTINCT f.package_id) AS count FROM fields f
    WHERE f.package_id IN (SELECT package_id FROM ({MATCH_SQL(ANY_TERMS, 1)}) m)
    GROUP BY f.field, f.value HAVING count(DISTINCT f.package_id) >= {mincount}) a) b {lim}"""


@query("facets", FACETS_SQL(50), dict(CTES, fields=FIELDS_SQL))
def facets(c):
    return sr.facets(stored_index(c).match(ANY_TERMS, 1), facet_fields(c), 1, 50)


@query("facets_limited", FACETS_SQL(2), dict(CTES, fields=FIELDS_SQL))
def facets_limited(c):
    return sr.facets(stored_index(c).match(ANY_TERMS, 1), facet_fields(c), 1, 2)


@query("facets_frequent", FACETS_SQL(-1, 3), dict(CTES, fields=FIELDS_SQL))
def facets_frequent(c):
    """Every value of at least three packages, without a limit."""
    return sr.facets(stored_index(c).match(ANY_TERMS, 1), facet_fields(c), 3, -1)


@query("search_default", f"""
SELECT package_id, rank FROM (
  SELECT package_id, row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank
  FROM package WHERE type <> 'harvest') x WHERE rank > {START} AND rank <= {START + ROWS}""")
def search_default(c):
    """A search without terms: all packages, newest first."""
    hits = sr.everything(c.package.filter(F.col("type") != "harvest"))
    return sr.page(hits, START, ROWS).select("package_id", "rank")


@query("search_sorted", f"""
SELECT x.rank, x.package_id, x.title, r.resource_id AS id FROM (
  SELECT s.package_id, p.title, row_number() OVER (ORDER BY p.title, s.package_id) AS rank
  FROM ({SCORE_SQL(ANY_TERMS, ANY_MIN)}) s JOIN package p ON p.package_id = s.package_id) x
JOIN resource r ON r.package_id = x.package_id WHERE x.rank <= {ROWS}""", CTES)
def search_sorted(c):
    """Search with an order of the caller's, answered as package views with
    their resources (the page is cut before views are built)."""
    hits = _ranked(c).join(c.package.select("package_id", "title"), "package_id")
    top = sr.page(hits, 0, ROWS, [F.col("title"), F.col("package_id")])
    views = assemble.nest_resources(c.package.select("package_id"), c.resource)
    return (views.join(F.broadcast(top.select("package_id", "title", "rank")), "package_id")
            .filter(F.col("resources").isNotNull())
            .select("rank", "package_id", "title", F.explode("resources").alias("r"))
            .select("rank", "package_id", "title", F.col("r.id").alias("id")))
