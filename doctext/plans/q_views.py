"""Registered queries: package assembly and the visibility views
(J2, J3, V2-V7, Q8-Q12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import assemble, save, search
from ..operators import visibility as V
from ..operators.keys import near_keys
from ..operators.texttable import TextTable
from ..session import scratch_path
from .params import SETTINGS as S
from .q_state import DEDUPED_SQL, J1_ALL_SQL, MERGE_SQL
from .registry import query

PAGE_OFFSET, PAGE_LIMIT, DEEP_OFFSET = 20, 25, 100

# Extras of a package: owner, source url, modification date and the label
# fields of its resources (max over the package).
EXTRAS_SQL = """
SELECT p.package_id, 'owner' AS key, CAST(p.owner AS VARCHAR) AS value FROM package p
UNION ALL SELECT p.package_id, 'source_url', p.url FROM package p
UNION ALL SELECT p.package_id, 'modified', strftime(p.metadata_modified, '%Y-%m-%d') FROM package p
UNION ALL SELECT concat('p', CAST(floor(doc_id / 4) AS BIGINT)), 'quality', CAST(max(quality) AS VARCHAR)
  FROM labels GROUP BY 1
"""


def packages_with_extras(c) -> DataFrame:
    lab = (c.raw("labels")
             .groupBy(F.concat(F.lit("p"), F.floor(F.col("doc_id") / 4).cast("bigint")).alias("package_id"))
             .agg(F.max("quality").cast("string").alias("quality")))
    tags = c.resource.groupBy("package_id").agg(F.array_sort(F.collect_set("format")).alias("tags"))
    p = c.package.join(lab, "package_id", "left").join(tags, "package_id", "left")
    extras = F.filter(F.array(
        F.struct(F.lit("owner").alias("key"), F.col("owner").cast("string").alias("value")),
        F.struct(F.lit("source_url").alias("key"), F.col("url").alias("value")),
        F.struct(F.lit("modified").alias("key"),
                 F.date_format("metadata_modified", "yyyy-MM-dd").alias("value")),
        F.struct(F.lit("quality").alias("key"), F.col("quality").alias("value"))),
        lambda e: e["value"].isNotNull())
    return p.withColumn("extras", extras).withColumn("extras_map", F.map_from_entries("extras")) \
            .drop("quality")


def explode_extras(df: DataFrame, col: str = "extras") -> DataFrame:
    return df.select("package_id", F.explode(col).alias("e")).select("package_id", "e.key", "e.value")


@query("hide_extras_list", """
SELECT package_id, key, value FROM extras WHERE key NOT IN ('owner')""", {"extras": EXTRAS_SQL})
def hide_extras_list(c):
    p = packages_with_extras(c).withColumn("extras", V.hide_extras_list("extras", S.hide_extras))
    return explode_extras(p)


@query("hide_extras_list_named", """
SELECT package_id, key, value FROM extras WHERE key <> 'source_url'""", {"extras": EXTRAS_SQL})
def hide_extras_list_named(c):
    p = packages_with_extras(c).withColumn("extras", V.hide_extras_list("extras", S.hide_extras, "source_url"))
    return explode_extras(p)


@query("hide_extras_map", """
SELECT package_id, key, value FROM extras WHERE key NOT IN ('owner')""", {"extras": EXTRAS_SQL})
def hide_extras_map(c):
    p = packages_with_extras(c).withColumn("m", V.hide_extras_map("extras_map", S.hide_extras))
    return p.select("package_id", F.explode("m").alias("key", "value"))


@query("hide_extras_list_absent", """
SELECT package_id, key, value FROM extras WHERE key NOT IN ('owner')""", {"extras": EXTRAS_SQL})
def hide_extras_list_absent(c):
    """V3 with a named key that no package has: falls back to the hidden set."""
    p = packages_with_extras(c).withColumn("extras", V.hide_extras_list("extras", S.hide_extras, "no_such_key"))
    return explode_extras(p)


@query("hide_extras_map_named", """
SELECT e.package_id, e.key, e.value FROM extras e
WHERE CASE WHEN e.package_id IN (SELECT package_id FROM extras WHERE key = 'quality') THEN e.key <> 'quality'
           ELSE e.key NOT IN ('owner') END""", {"extras": EXTRAS_SQL})
def hide_extras_map_named(c):
    """V2 with a named key: dropped where it is present, else the hidden set."""
    p = packages_with_extras(c).withColumn("m", V.hide_extras_map("extras_map", S.hide_extras, "quality"))
    return p.select("package_id", F.explode("m").alias("key", "value"))


@query("extra_value", """
SELECT p.package_id, e.value AS quality FROM package p
LEFT JOIN extras e ON e.package_id = p.package_id AND e.key = 'quality'""", {"extras": EXTRAS_SQL})
def extra_value(c):
    p = packages_with_extras(c)
    return p.select("package_id", V.extra_value("extras", "quality").alias("quality"))


@query("extras_to_list", """
SELECT package_id, key, value FROM extras
UNION ALL
SELECT package_id, 'tags', '[' || string_agg('"' || format || '"', ',' ORDER BY format) || ']'
FROM (SELECT DISTINCT package_id, format FROM resource) r
WHERE package_id IN (SELECT package_id FROM package) GROUP BY package_id""", {"extras": EXTRAS_SQL})
def extras_to_list(c):
    p = packages_with_extras(c).filter(F.col("tags").isNotNull())
    p = p.withColumn("l", V.extras_to_list("extras_map", {"tags": F.col("tags")}))
    q = packages_with_extras(c).filter(F.col("tags").isNull()).withColumn(
        "l", V.extras_to_list("extras_map"))
    return explode_extras(p.unionByName(q), "l")


@query("names_to_structs", """
SELECT DISTINCT r.package_id, r.format AS name FROM resource r JOIN package p ON p.package_id = r.package_id""")
def names_to_structs(c):
    p = packages_with_extras(c).withColumn("tag_structs", V.names_to_structs("tags"))
    return p.select("package_id", F.explode("tag_structs").alias("t")).select("package_id", "t.name")


@query("hide_main", "SELECT package_id, name, title, state, type, metadata_modified, owner FROM package")
def hide_main(c):
    return V.hide_main(c.package, S.hide_main)


# ---- nested packages ----------------------------------------------------
def _texts(c):
    return assemble.attach_fulltext(c.resource, c.fulltext, (), S.read_limit, S.package_blacklist)


def show_full(c) -> DataFrame:
    """Q8 full view: resources with their texts (readers with rights)."""
    return assemble.nest_resources(c.package, c.resource, _texts(c))


def show_reduced(c) -> DataFrame:
    """The reduced view: no texts, hidden extras and main fields removed."""
    p = assemble.nest_resources(packages_with_extras(c), c.resource)
    return V.hide_main(p.withColumn("extras", V.hide_extras_list("extras", S.hide_extras)), S.hide_main)


def with_https(p: DataFrame) -> DataFrame:
    """U6 on nested resources; Q8's reduced view alone has it."""
    return p.withColumn("resources", F.transform("resources", lambda r: r.withField(
        "url", U.fix_https(r["url"], S.https_host))))


FULL_SQL = f"""
WITH j1 AS ({J1_ALL_SQL.format(t="d.text", tc="d.text_clear")})
SELECT r.package_id, r.resource_id AS id, r.position, r.url, j1.text AS fulltext, j1.text_clear AS fulltext_clear
FROM resource r JOIN package p ON p.package_id = r.package_id
LEFT JOIN j1 ON j1.resource_id = r.resource_id"""


@query("nest_fulltext", FULL_SQL, {"deduped": DEDUPED_SQL})
def nest_fulltext(c):
    return assemble.explode_resources(show_full(c).filter(F.col("resources").isNotNull())) \
                   .select("package_id", "id", "position", "url", "fulltext", "fulltext_clear")


MAIN = ("title", "state", "type", "owner")
MAIN_SQL = "SELECT " + ", ".join(f"p.{m}" for m in MAIN) + ", r.package_id,"


def _main_sql(where: str = "") -> str:
    head, _, tail = FULL_SQL.rpartition("SELECT r.package_id,")
    return head + MAIN_SQL + tail + where


@query("package_show_full", _main_sql(), {"deduped": DEDUPED_SQL})
def package_show_full(c):
    """Q8 full view: every main field, resources with their texts."""
    p = show_full(c).filter(F.col("resources").isNotNull())
    return assemble.explode_resources(p, (*MAIN, "package_id")) \
                   .select(*MAIN, "package_id", "id", "position", "url", "fulltext", "fulltext_clear")


@query("strip_fulltext", """
SELECT r.package_id, r.resource_id AS id, r.position, r.url, r.name, r.format, r.file_size
FROM resource r JOIN package p ON p.package_id = r.package_id""")
def strip_fulltext(c):
    p = assemble.strip_fulltext(show_full(c).filter(F.col("resources").isNotNull()))
    return assemble.explode_resources(p)


@query("package_show_reduced", f"""
SELECT r.package_id, p.name, p.title, r.resource_id AS id, r.position,
  replace(r.url, 'http://{S.https_host}', 'https://{S.https_host}') AS url
FROM resource r JOIN package p ON p.package_id = r.package_id""")
def package_show_reduced(c):
    """Q8 reduced view: links of the portal's own host go to https."""
    p = with_https(show_reduced(c)).filter(F.col("resources").isNotNull())
    return p.select("package_id", "name", "title", F.explode("resources").alias("r")) \
            .select("package_id", "name", "title", "r.id", "r.position", "r.url")


@query("package_show_map", """
SELECT p.package_id, p.name, p.title, p.state, p.owner, e.key, e.value, r.resource_id AS id, r.position, r.url
FROM package p JOIN extras e ON e.package_id = p.package_id AND e.key NOT IN ('owner')
JOIN resource r ON r.package_id = p.package_id""", {"extras": EXTRAS_SQL})
def package_show_map(c):
    """Q9 reduced map view: whole packages without texts, hidden extras and
    hidden main fields; URLs as they are."""
    p = V.hide_main(assemble.nest_resources(packages_with_extras(c), c.resource), S.hide_main)
    p = p.withColumn("extras_map", V.hide_extras_map("extras_map", S.hide_extras))
    return _flat_map(p, ("package_id", "name", "title", "state", "owner"), ("id", "position", "url"))


def _flat_map(p: DataFrame, main: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """A map view as rows: one for every extra and resource of a package."""
    return (p.where("resources is not null").select(*main, "resources", F.explode("extras_map").alias("key", "value"))
            .select(*main, "key", "value", F.explode("resources").alias("r"))
            .select(*main, "key", "value", *[f"r.{f}" for f in fields]))


def _owner_sql() -> str:
    head, sep, tail = FULL_SQL.rpartition("SELECT r.package_id,")
    return head + "SELECT p.owner, r.package_id," + tail


@query("user_packages", _owner_sql(),
       {"deduped": DEDUPED_SQL})
def user_packages(c):
    """Q10: every user's packages with their resources and texts."""
    p = show_full(c).filter(F.col("resources").isNotNull())
    return assemble.explode_resources(p, ("owner", "package_id")) \
                   .select("owner", "package_id", "id", "position", "url", "fulltext", "fulltext_clear")


@query("package_list_page", f"""
SELECT package_id, metadata_modified, rank FROM (
  SELECT package_id, metadata_modified,
    row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank FROM package) x
WHERE rank > {PAGE_OFFSET} AND rank <= {PAGE_OFFSET + PAGE_LIMIT}""")
def package_list_page(c):
    """Q11: newest first, one page.  ``limit`` + ``offset`` on a global
    order is a top-k (each task keeps its best offset+limit rows), not a
    full sort."""
    top = c.package.orderBy(F.col("metadata_modified").desc(), "package_id") \
                   .limit(PAGE_OFFSET + PAGE_LIMIT)
    w = Window.orderBy(F.col("metadata_modified").desc(), "package_id")
    return top.select("package_id", "metadata_modified", F.row_number().over(w).alias("rank")) \
              .filter(F.col("rank") > PAGE_OFFSET)


@query("package_list_deep", f"""
SELECT package_id, metadata_modified, rank FROM (
  SELECT package_id, metadata_modified,
    row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank FROM package) x
WHERE rank > {DEEP_OFFSET} AND rank <= {DEEP_OFFSET + PAGE_LIMIT}""")
def package_list_deep(c):
    """Q11 far down the list: the ranges that hold the page are found by
    counts, the others are not read."""
    return search.page_at(c.package.select("package_id", "metadata_modified"), DEEP_OFFSET, PAGE_LIMIT,
                          [F.col("metadata_modified").desc(), F.col("package_id")], range_rows=32)


@query("package_list_after", f"""
SELECT package_id, metadata_modified FROM (
  SELECT package_id, metadata_modified,
    row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank FROM package) x
WHERE rank > {2 * PAGE_LIMIT} AND rank <= {3 * PAGE_LIMIT}""")
def package_list_after(c):
    """Q11 by cursor: the third page, each from the last row of the one before."""
    order, last = [("metadata_modified", True), ("package_id", False)], None
    rows = c.package.select("package_id", "metadata_modified")
    for _ in range(2):
        seen = search.page_after(rows, order, last, PAGE_LIMIT).tail(1)
        last = (seen[0]["metadata_modified"], seen[0]["package_id"])
    return search.page_after(rows, order, last, PAGE_LIMIT)


# ---- create and update ----------------------------------------------------
SENT_SQL = f"""
SELECT i.package_id, i.resource_id, i.text, r.url,
  row_number() OVER (PARTITION BY i.package_id ORDER BY i.position) - 1 AS position
FROM incoming i JOIN resource r ON r.resource_id = i.resource_id"""


def sent_packages(c, only=None) -> DataFrame:
    """Packages as a client sends them: main fields, extras, and resources in
    order, each with its text inside."""
    inc = c.incoming.join(c.resource.select("resource_id", "url", F.col("name").alias("res_name")), "resource_id")
    nested = inc.groupBy("package_id").agg(F.array_sort(F.collect_list(F.struct(
        "position", F.struct(F.col("resource_id").alias("id"), "url", F.col("res_name").alias("name"),
                             F.col("text").alias("fulltext")).alias("r")))).alias("l"))
    p = packages_with_extras(c).drop("extras_map", "tags").join(nested, "package_id")
    p = p.withColumn("resources", F.transform("l", lambda x: x["r"])).drop("l")
    return p if only is None else p.where(only)


@query("lift_fulltext", """
SELECT s.package_id, s.resource_id, s.position, coalesce(s.text, '') AS text FROM sent s JOIN package p ON p.package_id = s.package_id""",
       {"sent": SENT_SQL})
def lift_fulltext(c):
    """Q12: texts sent inside the resources of a create or update, lifted out
    by position."""
    return save.lift(sent_packages(c))


OWNER_LIMIT = 75


@query("user_packages_reduced", f"""
SELECT p.package_id, p.name, r.resource_id AS id,
  r.url, e.key, e.value
FROM package p JOIN resource r ON r.package_id = p.package_id
JOIN extras e ON e.package_id = p.package_id AND e.key NOT IN ('owner') WHERE p.owner < {OWNER_LIMIT}""", {"extras": EXTRAS_SQL})
def user_packages_reduced(c):
    """Q10, some users only, for readers without rights: no texts, no hidden
    extras; URLs as they are."""
    p = show_reduced(c).filter(F.col("resources").isNotNull() & (F.col("owner") < OWNER_LIMIT))
    return (p.select("package_id", "name", "resources", F.explode("extras").alias("e"))
            .select("package_id", "name", "e", F.explode("resources").alias("r"))
            .select("package_id", "name", "r.id", "r.url", "e.key", "e.value"))


PAGE, PAGE_SIZE = 3, 10


@query("package_list_views", f"""
SELECT x.rank, p.package_id, p.name, p.title, r.resource_id AS id, r.url
FROM (SELECT package_id, row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank FROM package) x
JOIN package p ON p.package_id = x.package_id JOIN resource r ON r.package_id = p.package_id
WHERE x.rank > {(PAGE - 1) * PAGE_SIZE} AND x.rank <= {PAGE * PAGE_SIZE}""")
def package_list_views(c):
    """Q11 by page number, with the reduced view of each listed package: the
    page is cut first (a top-k), so views are built for its packages only."""
    order = [F.col("metadata_modified").desc(), F.col("package_id")]
    top = c.package.orderBy(*order).limit(PAGE * PAGE_SIZE)
    listed = top.select("package_id", F.row_number().over(Window.orderBy(*order)).alias("rank")) \
                .filter(F.col("rank") > (PAGE - 1) * PAGE_SIZE)
    p = show_reduced(c).join(F.broadcast(listed), "package_id").filter(F.col("resources").isNotNull())
    return p.select("rank", "package_id", "name", "title", F.explode("resources").alias("r")) \
            .select("rank", "package_id", "name", "title", "r.id", "r.url")


@query("package_list_texts", f"""
WITH j1 AS ({J1_ALL_SQL.format(t="d.text", tc="d.text_clear")})
SELECT x.rank, p.package_id, p.name, r.resource_id AS id, r.position, j1.text AS fulltext
FROM (SELECT package_id, row_number() OVER (ORDER BY metadata_modified DESC, package_id) AS rank FROM package) x
JOIN package p ON p.package_id = x.package_id JOIN resource r ON r.package_id = p.package_id
LEFT JOIN j1 ON j1.resource_id = r.resource_id
WHERE x.rank > {(PAGE - 1) * PAGE_SIZE} AND x.rank <= {PAGE * PAGE_SIZE}""", {"deduped": DEDUPED_SQL})
def package_list_texts(c):
    """Q11 for readers with rights: the listed packages with their texts; only
    texts of the page's packages are joined."""
    order = [F.col("metadata_modified").desc(), F.col("package_id")]
    listed = search.page(c.package, (PAGE - 1) * PAGE_SIZE, PAGE_SIZE, order).select("package_id", "name", "rank")
    res = c.resource.join(listed.select("package_id"), "package_id", "left_semi")
    texts = assemble.attach_fulltext(res, near_keys(c.fulltext, listed, "package_id"), (), 0, S.package_blacklist)
    p = assemble.nest_resources(listed, res, texts)
    return p.select("rank", "package_id", "name", F.explode("resources").alias("r")).select(
        "rank", "package_id", "name", "r.id", "r.position", "r.fulltext")


@query("package_show_map_full", f"""
WITH j1 AS ({J1_ALL_SQL.format(t="d.text", tc="d.text_clear")})
SELECT p.package_id, p.name, p.url AS package_url, e.key, e.value, r.resource_id AS id, r.position, j1.text AS fulltext
FROM package p JOIN extras e ON e.package_id = p.package_id JOIN resource r ON r.package_id = p.package_id
LEFT JOIN j1 ON j1.resource_id = r.resource_id""", {"extras": EXTRAS_SQL, "deduped": DEDUPED_SQL})
def package_show_map_full(c):
    """Q9 full map view: every field and extra, resources with their texts."""
    p = assemble.nest_resources(packages_with_extras(c).withColumnRenamed("url", "package_url"), c.resource, _texts(c))
    return _flat_map(p, ("package_id", "name", "package_url"), ("id", "position", "fulltext"))


def _saved(c, table_rows: DataFrame, only=None) -> save.Saved:
    table = TextTable(c.spark, scratch_path(c.spark, "fulltext"), 16)
    table.create(table_rows)
    return save.save_packages(sent_packages(c, only), table, scratch_path(c.spark, "packages"))


def _flat_answer(p: DataFrame, main: tuple[str, ...], *fields: str) -> DataFrame:
    return p.select(*main, F.posexplode("resources").alias("position", "r")).select(
        *main, F.col("position").cast("long").alias("position"), *[F.col(f"r.{f}").alias(f) for f in fields])


UPDATED_SQL = """
SELECT p.package_id, p.name, p.url AS package_url, s.position, s.resource_id AS id, s.url,
  CASE WHEN p.state <> 'deleted' THEN CASE WHEN regexp_matches(coalesce(s.text, ''), '^\\s*$') THEN 'NOT_AVAILABLE' ELSE s.text END END AS fulltext
FROM sent s JOIN package p ON p.package_id = s.package_id"""


@query("package_update", UPDATED_SQL, {"sent": SENT_SQL})
def package_update(c):
    """Q12: an update, stored in both tables, and the answer for readers with
    rights: the stored packages with the new texts by position (a deleted
    package keeps none)."""
    p = save.answer_full(_saved(c, c.fulltext)).withColumnRenamed("url", "package_url")
    return _flat_answer(p, ("package_id", "name", "package_url"), "id", "url", "fulltext")


@query("package_update_reduced", """
SELECT s.package_id, p.name, s.position, s.resource_id AS id, s.url, e.key, e.value
FROM sent s JOIN package p ON p.package_id = s.package_id
JOIN extras e ON e.package_id = p.package_id AND e.key NOT IN ('owner')""", {"sent": SENT_SQL, "extras": EXTRAS_SQL})
def package_update_reduced(c):
    """Q12: the answer for readers without rights."""
    p = save.answer_reduced(_saved(c, c.fulltext), S.hide_extras, S.hide_main)
    assert "url" not in p.columns and "fulltext" not in p.schema["resources"].dataType.elementType.names
    return _flat_answer(p.select("package_id", "name", "resources", F.explode("extras").alias("e")).select(
        "package_id", "name", "resources", "e.key", "e.value"), ("package_id", "name", "key", "value"), "id", "url")


@query("package_update_table", f"""
WITH m AS ({MERGE_SQL.replace("FROM incoming", "FROM sent")})
SELECT id, resource_id, package_id, text, text_clear FROM m WHERE action IN ('keep', 'update', 'insert')""", {
    "sent": f"SELECT x.package_id, x.resource_id, x.position, x.text FROM ({SENT_SQL}) x JOIN package p ON p.package_id = x.package_id"})
def package_update_table(c):
    """Q12: the text table after the update, read back."""
    return _saved(c, c.fulltext).table.read()


CREATED = "CAST(substr(package_id, 2) AS BIGINT) % 3 = 1"


@query("package_create", f"""
SELECT x.package_id, x.resource_id, x.id, x.text, x.text_clear FROM (
  SELECT f.package_id, f.resource_id, f.id, f.text, f.text_clear FROM fulltext f WHERE NOT ({CREATED})
  UNION ALL
  SELECT s.package_id, s.resource_id, concat(s.resource_id, '-new'),
    CASE WHEN regexp_matches(coalesce(s.text, ''), '^\\s*$') THEN 'NOT_AVAILABLE' ELSE s.text END, NULL
  FROM sent s JOIN package p ON p.package_id = s.package_id
  WHERE {CREATED.replace("package_id", "s.package_id")} AND p.state <> 'deleted') x""", {"sent": SENT_SQL})
def package_create(c):
    """Q12: packages that had no texts are created; the text table holds a new
    row for each of their resources."""
    made = F.expr(CREATED)
    return _saved(c, c.fulltext.where(~made), made).table.read()
