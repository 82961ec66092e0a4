"""Registered queries: normalisation, token predicates and URL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls as U
from ..operators import assemble
from ..schema import SPECIALS_DELETE, WORD_DELIMITERS, WORD_STRIP
from .params import CUT_CHARS, SETTINGS as S
from .registry import query

Q = tx.sql_quote

# ---- SQL building blocks for the oracle --------------------------------
SPACE_CHARS_SQL = "chr(10) || chr(9) || chr(226) || chr(128) || chr(162) || chr(239) || chr(191) || chr(189)"


def sql_remove_specials(x: str, csv: bool = False) -> str:
    if csv:
        x = f"replace({x}, ';', ' ')"
    x = f"translate({x}, {Q(SPECIALS_DELETE)}, '')"
    return f"translate({x}, {SPACE_CHARS_SQL}, '        ')"


def sql_normalise(x: str, csv: bool = False) -> str:
    x = f"replace(replace({x}, chr(65533), ''), '-' || chr(10), '')"
    return sql_remove_specials(x, csv)


def sql_words(x: str, delimiters: str = WORD_DELIMITERS) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, {Q(tx.re2_class(delimiters))}), "
            f"lambda w: trim(w, {Q(WORD_STRIP)})), lambda w: w <> '')")


def sql_explode(source: str, key: str, arr: str, value: str) -> str:
    """(key, pos, value) rows of an array, positions from 0."""
    return (f"SELECT {key}, i - 1 AS pos, {value.replace('@', 'arr[i]')} AS {'word' if value == '@' else 'value'} "
            f"FROM (SELECT {key}, arr, unnest(generate_series(1, len(arr))) AS i "
            f"FROM (SELECT {key}, {arr} AS arr FROM {source}) a) b")


# Hyphen breaks, replacement characters and CSV separators are not in the
# generated texts, so the normalisation queries inject them.
INJECT = "replace(replace(replace(text, 'er ', '-' || chr(10) || 'er'), 'a', 'a' || chr(65533)), ' ', ';')"


def _inject(col):
    x = F.replace(col, F.lit("er "), F.lit("-\ner"))
    x = F.replace(x, F.lit("a"), F.lit("a�"))
    return F.replace(x, F.lit(" "), F.lit(";"))


@query("normalise", f"SELECT doc_id, {sql_normalise(INJECT)} AS text FROM documents")
def normalise(c):
    d = c.documents
    return d.select("doc_id", tx.normalise(_inject(F.col("text"))).alias("text"))


@query("remove_specials", f"SELECT doc_id, {sql_remove_specials('text')} AS text FROM documents")
def remove_specials(c):
    return c.documents.select("doc_id", tx.remove_specials("text").alias("text"))


@query("remove_specials_csv", f"SELECT doc_id, {sql_remove_specials(INJECT, True)} AS text FROM documents")
def remove_specials_csv(c):
    return c.documents.select("doc_id", tx.remove_specials(_inject(F.col("text")), True).alias("text"))


@query("normalise_list", sql_explode("documents", "doc_id", "string_split(text, chr(10))",
                                     sql_normalise("@")).replace("AS value", "AS line"))
def normalise_list(c):
    d = c.documents.select("doc_id", tx.normalise_list(F.split("text", "\n")).alias("lines"))
    return d.select("doc_id", F.posexplode("lines").alias("pos", "line"))


@query("words_default", sql_explode("documents", "doc_id", sql_words("text"), "@"))
def words_default(c):
    return c.documents.select("doc_id", F.posexplode(tx.words("text")).alias("pos", "word"))


@query("words_space", sql_explode("documents", "doc_id", sql_words("text", " "), "@"))
def words_space(c):
    return c.documents.select("doc_id", F.posexplode(tx.words("text", " ")).alias("pos", "word"))


@query("flatten_tokens", sql_explode(
    "documents", "doc_id",
    f"flatten(list_transform(string_split(text, chr(10)), lambda l: {sql_words('l', ' ')}))", "@"))
def flatten_tokens(c):
    lines = F.transform(F.split("text", "\n"), lambda l: tx.words(l, " "))
    return c.documents.select("doc_id", F.posexplode(tx.flatten_tokens(lines)).alias("pos", "word"))


@query("token_class", f"""
SELECT doc_id, pos, word,
  (ends_with(word, '.de') OR ends_with(word, '.com') OR starts_with(word, 'http')) AS is_url,
  (length(word) > 7 AND regexp_matches(word, '^[^@]+@[^@]+\\.[^@]+')) AS is_email
FROM ({sql_explode("documents", "doc_id", sql_words("text", " "), "@")}) t""")
def token_class(c):
    w = c.documents.select("doc_id", F.posexplode(tx.words("text", " ")).alias("pos", "word"))
    return w.select("doc_id", "pos", "word", tx.is_url_token("word").alias("is_url"),
                    tx.is_email_token("word").alias("is_email"))


@query("is_error_page", """
SELECT doc_id, coalesce(contains(text, '404 - File or directory not found')
  OR contains(text, '404 Not Found   Not Found') OR contains(text, 'NOT_AVAILABLE')
  OR contains(text, 'The page cannot be displayed because')
  OR contains(text, 'The requested URL could not be retrieved'), false) AS is_error
FROM (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN concat(text, ' NOT_AVAILABLE') ELSE text END AS text
      FROM documents) d""")
def is_error_page(c):
    t = F.when(F.col("doc_id") % 13 == 0, F.concat("text", F.lit(" NOT_AVAILABLE"))).otherwise(F.col("text"))
    return c.documents.select("doc_id", tx.is_error_page(t).alias("is_error"))


@query("truncate_text", f"SELECT doc_id, left(text, {CUT_CHARS}) AS text FROM documents")
def truncate_text(c):
    return c.documents.select("doc_id", tx.truncate("text", CUT_CHARS).alias("text"))


# ---- URLs ---------------------------------------------------------------
# URL fixtures: page URLs as they are, case-file URLs with spaces, umlauts,
# '~', '*', path parameters and fragments, and local paths.
URLS_SQL = """
SELECT page_id AS k, url FROM pages
UNION ALL
SELECT page_id + 100000000, concat('http://zs.example.org///svc/', page_id, '/Akte:AB', page_id, '.52-20/0008 x.pdf') FROM pages
UNION ALL
SELECT page_id + 200000000, concat('https://h.example.org/a b/', page_id, '/ü~*+(1).html;v=', page_id, '?q=', page_id, '#frag') FROM pages
UNION ALL
SELECT page_id + 300000000, concat('/srv/data/', page_id, '.txt') FROM pages
"""

URL_RE = U._URL_RE


def _urls(c):
    p = c.pages.select("page_id", "url")
    return (p.select(F.col("page_id").alias("k"), "url")
            .unionByName(p.select((F.col("page_id") + 100000000).alias("k"),
                                  F.concat(F.lit("http://zs.example.org///svc/"), "page_id",
                                           F.lit("/Akte:AB"), "page_id", F.lit(".52-20/0008 x.pdf")).alias("url")))
            .unionByName(p.select((F.col("page_id") + 200000000).alias("k"),
                                  F.concat(F.lit("https://h.example.org/a b/"), "page_id",
                                           F.lit("/ü~*+(1).html;v="), "page_id", F.lit("?q="), "page_id",
                                           F.lit("#frag")).alias("url")))
            .unionByName(p.select((F.col("page_id") + 300000000).alias("k"),
                                  F.concat(F.lit("/srv/data/"), "page_id", F.lit(".txt")).alias("url"))))


def sql_case_file(u: str) -> str:
    u1 = f"(CASE WHEN instr({u}, '///') > 1 THEN replace({u}, '///', '//') ELSE {u} END)"
    p = f"instr({u1}, '//')"
    rest = f"substring({u1}, {p} + 2)"
    a = f"instr({rest}, '/Akte')"
    return (f"concat(left({u1}, {p} + 1), left({rest}, {a}), "
            f"translate(substring({rest}, {a} + 1), '/%:', ''))")


def sql_part(u: str, i: int) -> str:
    return f"regexp_extract({u}, {Q(URL_RE)}, {i})"


def sql_normalise_url(u: str) -> str:
    v = f"(CASE WHEN instr({u}, '/Akte') > 1 THEN {sql_case_file(u)} ELSE {u} END)"
    path = f"regexp_replace({sql_part(v, 3)}, ';[^/]*$', '')"
    enc = f"replace(replace(url_encode({path}), '%2F', '/'), '%25', '%')"
    base = f"concat(lower({sql_part(v, 1)}), '://', {sql_part(v, 2)}, {enc})"
    q = sql_part(v, 4)
    return (f"CASE WHEN starts_with({u}, '/') THEN {u} WHEN {q} <> '' THEN concat({base}, '?', {q}) "
            f"ELSE {base} END")


@query("case_file_url", f"SELECT k, {sql_case_file('url')} AS url FROM urls WHERE instr(url, '/Akte') > 1",
       {"urls": URLS_SQL})
def case_file_url(c):
    u = _urls(c)
    return u.filter(F.instr("url", "/Akte") > 1).select("k", U.case_file_url("url").alias("url"))


@query("normalise_url", f"SELECT k, {sql_normalise_url('url')} AS url FROM urls", {"urls": URLS_SQL})
def normalise_url(c):
    return _urls(c).select("k", U.normalise_url("url").alias("url"))


REL_SQL = """
SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN concat('./p', page_id, '.html')
  WHEN 1 THEN concat('../p', page_id, '.html') WHEN 2 THEN concat('../../x/p', page_id, '.html')
  ELSE concat('../../../../../r', page_id) END AS rel
FROM pages"""


def sql_dirname(path: str, times: str) -> str:
    segs = f"string_split({path}, '/')"
    head = f"array_to_string(list_slice({segs}, 1, greatest(len({segs}) - ({times}), 1)), '/')"
    return f"(CASE WHEN {head} = '' AND starts_with({path}, '/') THEN '/' ELSE {head} END)"


def sql_resolve(rel: str, url: str) -> str:
    ups = f"((length({rel}) - length(replace({rel}, '../', ''))) // 3)"
    times = f"(CASE WHEN starts_with({rel}, '..') THEN {ups} + 1 ELSE 1 END)"
    begin = sql_dirname(sql_part(url, 3), times)
    append = f"concat('/', trim({rel}, './'))"
    netloc = sql_part(url, 2)
    return (f"concat(lower({sql_part(url, 1)}), ':', CASE WHEN {netloc} <> '' THEN concat('//', {netloc}) ELSE '' END, "
            f"CASE WHEN {begin} = '/' THEN '' ELSE {begin} END, {append})")


def _rel(c):
    p = c.pages.select("page_id", "url")
    m = F.col("page_id") % 4
    rel = (F.when(m == 0, F.concat(F.lit("./p"), "page_id", F.lit(".html")))
            .when(m == 1, F.concat(F.lit("../p"), "page_id", F.lit(".html")))
            .when(m == 2, F.concat(F.lit("../../x/p"), "page_id", F.lit(".html")))
            .otherwise(F.concat(F.lit("../../../../../r"), "page_id")))
    return p.withColumn("rel", rel)


@query("resolve_relative", f"SELECT page_id, {sql_resolve('rel', 'url')} AS target FROM rel",
       {"rel": REL_SQL})
def resolve_relative(c):
    return _rel(c).select("page_id", U.resolve_relative("rel", "url").alias("target"))


FILES_SQL = """
SELECT resource_id AS k, url AS f FROM resource
UNION ALL
SELECT concat('m', archive_id, '-', seq), concat(' /tmp/x/', path, '.bak ') FROM members"""

PYWS = "[\\t\\n\\x0B\\x0C\\r\\x1C-\\x1F \\x{85}\\x{A0}]"


@query("file_stem", f"""
SELECT k, CASE WHEN starts_with(f, 'htt') THEN replace(translate(f, '/:', ''), '.', '_')
  ELSE regexp_replace(split_part(string_split(f, '/')[-1], '.', 1), '^{PYWS}+|{PYWS}+$', '', 'g') END AS stem
FROM files""", {"files": FILES_SQL})
def file_stem(c):
    r = c.resource.select(F.col("resource_id").alias("k"), F.col("url").alias("f"))
    m = c.members.select(F.concat(F.lit("m"), "archive_id", F.lit("-"), "seq").alias("k"),
                         F.concat(F.lit(" /tmp/x/"), "path", F.lit(".bak ")).alias("f"))
    return r.unionByName(m).select("k", U.file_stem("f").alias("stem"))


@query("local_url", """
SELECT k, CASE WHEN starts_with(url, '/') THEN concat('file://', url) ELSE url END AS url FROM urls""",
       {"urls": URLS_SQL})
def local_url(c):
    return _urls(c).select("k", U.local_url("url").alias("url"))


@query("fix_https", f"""
SELECT resource_id, replace(replace(url, 'https://', 'http://'), 'http://{S.https_host}', 'https://{S.https_host}') AS url
FROM resource""")
def fix_https(c):
    http = F.replace(F.col("url"), F.lit("https://"), F.lit("http://"))
    return c.resource.select("resource_id", U.fix_https(http, S.https_host).alias("url"))


GUID_SQL = """
SELECT package_id, CASE WHEN count(*) = 1 THEN min(guid) END AS guid
FROM harvest WHERE current AND state = 'COMPLETE' GROUP BY package_id"""


@query("harvest_guid", GUID_SQL)
def harvest_guid(c):
    return assemble.harvest_guid(c.harvest)


@query("harvest_source", """
SELECT package_id, arg_min(source_title, (guid, source_title)) AS source_title
FROM harvest WHERE current GROUP BY package_id""")
def harvest_source(c):
    return assemble.harvest_source(c.harvest)


def sql_fulltext_url() -> str:
    u = "r.url"
    path, netloc, scheme = sql_part(u, 3), sql_part(u, 2), f"lower({sql_part(u, 1)})"
    inst = (f"(CASE WHEN instr({path}, '/bi/') > 0 THEN '/bi/' "
            f"WHEN instr({path}, '/ti/') > 0 THEN '/ti/' END)")
    vol = "CASE WHEN contains(g.guid, '#volfdnr=') THEN split_part(split_part(g.guid, '#volfdnr=', 2), '#', 1) END"
    gid = "CASE WHEN contains(g.guid, '#guid=') THEN split_part(g.guid, '#guid=', 2) END"
    doctype = ("CASE WHEN NOT contains(r.url, 'sitzungsdienst') THEN NULL "
               "WHEN contains(r.name, 'Sitzungsprotokoll (Druckversion) ') THEN 'protocol' "
               "WHEN contains(p.title, 'Drucksache ') THEN 'document' END")
    proto = f"('https://' || {netloc} || {inst} || 'do027.asp?DOLFDNR=' || {vol} || '&options=64&dtyp=116')"
    doc = f"({scheme} || '://' || {netloc} || {inst} || 'do027.asp?DOLFDNR=' || {gid} || '&options=64&dtyp=130')"
    return f"""
SELECT r.resource_id, {doctype} AS doctype,
  coalesce(CASE {doctype} WHEN 'protocol' THEN {proto} WHEN 'document' THEN {doc} END, r.url) AS text_url
FROM resource r JOIN package p ON p.package_id = r.package_id
LEFT JOIN ({GUID_SQL}) g ON g.package_id = r.package_id"""


def text_urls(c):
    """U7 over every resource: its package title and harvest guid joined in."""
    r = c.resource.join(c.package.select("package_id", "title"), "package_id") \
                  .join(assemble.harvest_guid(c.harvest), "package_id", "left")
    return r.select("resource_id", U.meeting_doctype("url", "title", "name").alias("doctype"),
                    U.fulltext_url("url", "title", "name", "guid").alias("text_url"))


@query("fulltext_url", sql_fulltext_url())
def fulltext_url(c):
    return text_urls(c)
