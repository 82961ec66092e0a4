"""The registered queries of the operators: thin, whole tables, their
production parameters.  ``ORACLES`` has DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from .common import prepare
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uniform shuffle of all documents into 8 shards, counts at most one apart."""
    from .sharding import shard_documents
    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 5, 2, 1 by source."""
    from .mixing import mix
    return mix(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, 2 bits."""
    from .simhash import simhash_groups
    return (simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2)
            .select("doc_id", "fingerprint", "component_id"))


@query("op7_embeddings")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all vectors, cosine 0.98 within a label."""
    from .embeddings import embedding_groups
    return embedding_groups(table(spark, sf_dir, "embeddings"), threshold=0.98)


# Windows are counted per document by their eight words glued with a byte
# that no word holds; lines compare as whole strings.
OP3_SQL = r"""
with d as (
  select doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         string_split(coalesce(text, ''), chr(10)) as l
  from documents),
win as (
  select doc_id, i, array_to_string(w[i:i + 7], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from win) where n > 1),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from twice, (select unnest(range(8)) as k) group by doc_id),
lines as (
  select doc_id, count(*) - count(distinct x) as n_dup_lines
  from (select doc_id, unnest(l) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]') group by doc_id),
m as (
  select d.doc_id, len(w) as n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(l) as n_lines, coalesce(n_dup_lines, 0) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper
  from d left join lines using (doc_id) left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 4 * n_symbols > n_words
            or (n_lines >= 4 and 2 * n_dup_lines > n_lines) or 2 * n_upper > word_chars
            or word_chars > 25 * n_words) as kept
from m
"""


@query("op3_rules", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the strict policy."""
    from .rules import BASE, STRICT, apply_policy, ledger
    rows = apply_policy(ledger(table(spark, sf_dir, "documents")), STRICT)
    return rows.selectExpr("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           f"failed & {BASE.mask}L != 0 as base_failed", "kept")


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by the line field, labels of other folds only."""
    from .quality import quality_scores
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along the curve into sequences of at most 1024 tokens."""
    from .packing import pack
    return pack(table(spark, sf_dir, "documents"), length=1024)


OP4_SQL = r"""
with d as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as g
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50)),
bad as (
  select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as first_id from win)
  where first_id < doc_id),
gone as (select distinct doc_id, i + k as j from bad, (select unnest(range(50)) as k)),
words as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as j from d),
kept as (
  select doc_id, sha256(string_agg(x, ' ' order by j)) as s
  from words anti join gone using (doc_id, j) group by doc_id),
n as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
       coalesce(s, sha256('')) as kept_sha256
from d left join n using (doc_id) left join kept using (doc_id)
"""


@query("op4_substring", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word windows an earlier document has."""
    from .substring import digests
    return digests(table(spark, sf_dir, "documents"), window=50)


@query("op6_language_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of all documents, learnt from six folds of seven."""
    from .language import language_scores
    return language_scores(table(spark, sf_dir, "documents"))


def _op8_sql() -> str:
    from .licenses import LICENSE_FILES, TEMPLATES, THRESHOLD
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(a)}, {quote(b)})" for i, (a, b) in enumerate(TEMPLATES))
    names = ", ".join(map(quote, LICENSE_FILES))
    return rf"""
with templates(template, license, text) as (values {rows}),
f as (
  select doc_id, coalesce(text, '') as text, (doc_id // 1000) || case when doc_id % 1000 = 0 then '' else '/' || (doc_id // 100) end
           || case when doc_id % 100 = 0 then '' else '/' || (doc_id // 10) end as dir,
         case when doc_id % 10 = 0 then 'LICENSE' else 'DOC' end as base from documents),
tw as (
  select template, license, term, count(*) as tf
  from (select template, license, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as term from templates)
  group by all),
df as (
  select term, count(*) as df
  from (select distinct doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) as term from f)
  where term in (select term from tw) group by term),
total as (select 1.0 + count(*) as n from f),
w as (
  select template, license, term, tf * ln(n / (1.0 + coalesce(df, 0))) as w, ln(n / (1.0 + coalesce(df, 0))) as idf
  from tw left join df using (term), total),
norm as (select template, sqrt(sum(w * w)) as norm from w group by template),
lines as (
  select doc_id, unnest(l) as x, unnest(range(len(l))) as line
  from (select doc_id, string_split(text, chr(10)) as l from f)),
tf as (
  select doc_id, line, term, count(*) as tf
  from (select doc_id, line, unnest(regexp_extract_all(lower(x), '[a-z0-9]+')) as term from lines) group by all),
x as (
  select doc_id, line, term, tf * coalesce(idf, ln(n)) as x
  from tf left join (select distinct term, idf from w) using (term), total),
size as (select doc_id, line, sqrt(sum(x * x)) as size from x group by all),
dots as (
  select doc_id, line, template, license, sum(x * w) as dot from x join w using (term) group by all),
hit as (
  select doc_id, line, license, template, round(dot / (size * norm), 9) as score
  from dots join size using (doc_id, line) join norm using (template) where dot / (size * norm) >= {THRESHOLD}),
own as (
  select doc_id, license, score
  from (select *, row_number() over (partition by doc_id order by score desc, line, template) as r from hit) where r = 1),
grants as (
  select dir, license, score
  from (select f.dir, own.license, own.score,
               row_number() over (partition by dir order by score desc, license desc) as r
        from f join own using (doc_id) where base in ({names})) where r = 1),
up as (
  select distinct dir, depth, array_to_string(p[1:len(p) - depth], '/') as above
  from (select dir, p, unnest(range(len(p) + 1)) as depth
        from (select distinct dir, string_split(dir, '/') as p from f))),
nearest as (
  select dir, depth, license, score
  from (select up.dir, depth, license, score,
               row_number() over (partition by up.dir order by depth, license, score) as r
        from up join grants on grants.dir = up.above) where r = 1)
select f.doc_id, coalesce(own.license, nearest.license) as license,
       round(coalesce(own.score, nearest.score), 6) as score,
       case when own.license is not null then 'own' when nearest.license is not null then 'inherited' end as origin,
       case when own.license is not null then 0 else nearest.depth end as depth
from f left join own using (doc_id) left join nearest using (dir)
"""


@query("op8_licenses", _op8_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents, laid out as files in directories of a
    thousand, a hundred and ten; the first of each is its licence file."""
    from pyspark.sql import functions as F

    from .licenses import scan
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws(
        "/", F.expr("doc_id div 1000"), F.when(F.col("doc_id") % 1000 != 0, F.expr("doc_id div 100")),
        F.when(F.col("doc_id") % 100 != 0, F.expr("doc_id div 10")),
        F.when(F.col("doc_id") % 10 == 0, "LICENSE").otherwise(F.concat("doc_id", F.lit(".txt"))))
    return scan(docs.select(F.col("doc_id").alias("fid"), path.alias("path"), "text")).withColumnRenamed("fid", "doc_id")


@query("op11_conversations")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged and repaired to the role grammar."""
    from .dialogue import damage, repair
    return repair(damage(table(spark, sf_dir, "conversations")))


@query("op12_main_text")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    from .extraction import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between the byte-level and the piece vocabulary."""
    from .alignment import align_documents
    return align_documents(table(spark, sf_dir, "documents"))
