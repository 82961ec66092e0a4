"""Registered queries: maintenance of the stored index (Q1, Q2 with W3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as sr
from ..operators.index import SearchIndex, merge_and_index
from ..session import scratch_path
from .params import SETTINGS as S
from .q_search import ANY_MIN, ANY_TERMS, INDEX_SQL, POSTINGS_SQL, SCORE_SQL, built_index
from .q_state import DEDUPED_SQL, MERGE_SQL
from .registry import query

NUMBER = "CAST(substr(package_id, 2) AS BIGINT)"
INC1 = f"SELECT * FROM incoming WHERE {NUMBER} % 2 = 0"
#: Also packages of the first batch again; their third resource is gone.
INC2 = f"""SELECT package_id, resource_id, position, concat(text, ' the erneut') AS text
FROM incoming WHERE {NUMBER} % 3 = 0 AND position <> 2"""


def _merged(old: str, new: str) -> str:
    sql = MERGE_SQL.replace("fulltext", old).replace("FROM incoming", f"FROM {new}")
    return f"SELECT id, resource_id, package_id, text, text_clear FROM ({sql}) x WHERE action IN ('keep', 'update', 'insert')"


CTES = {
    "inc1": INC1, "inc2": INC2, "m1": _merged("fulltext", "inc1"), "m2": _merged("m1", "inc2"),
    "deduped2": DEDUPED_SQL.replace("fulltext", "m2"), "idx2": INDEX_SQL.replace("deduped", "deduped2"),
    "post2": POSTINGS_SQL.replace("FROM idx", "FROM idx2"),
}


def maintained(c) -> SearchIndex:
    """The index of the old table after two batches of saved packages."""
    index = built_index(c)
    listed = c.resource.join(
        c.package.where((F.col("type") != "harvest") & ~F.col("package_id").isin(*S.package_blacklist)).select("package_id"),
        "package_id", "left_semi")
    number = F.expr(NUMBER.replace("VARCHAR", "STRING"))
    first = c.incoming.where(number % 2 == 0)
    second = c.incoming.where((number % 3 == 0) & (F.col("position") != 2)).withColumn(
        "text", F.concat("text", F.lit(" the erneut")))
    table, index = merge_and_index(index, c.fulltext, first, c.package, listed, 1)
    return merge_and_index(index, table, second, c.package, listed, 2)[1]


@query("index_maintained", "SELECT term, package_id, tf FROM post2", CTES)
def index_maintained(c):
    """Signed differences of two batches added up equal a rebuilt index."""
    return maintained(c).postings()


@query("index_maintained_lengths", "SELECT package_id, sum(tf) AS dl FROM post2 GROUP BY package_id", CTES)
def index_maintained_lengths(c):
    return maintained(c).compact(scratch_path(c.spark, "index")).lengths()


@query("search_after_update", "SELECT * REPLACE (round(score, 3) AS score) FROM ("
       + SCORE_SQL(ANY_TERMS, ANY_MIN).replace("FROM post", "FROM post2") + ") s", CTES)
def search_after_update(c):
    """Scores by the maintained index, with its maintained statistics."""
    return sr.ranked(maintained(c).bm25(ANY_TERMS, ANY_MIN), c.package).withColumn("score", F.round("score", 3))
