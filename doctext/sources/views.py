"""Catalogue views derived from the driver tables.

Each view is one SQL template.  Spark runs it with ``spark.sql(template,
**frames)`` (the ``{name}`` placeholders become DataFrame references, so
Catalyst still prunes columns and pushes filters into the Parquet scans);
the oracle renders the same text with plain table names as a CTE.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "package": """
SELECT concat('p', p.page_id) AS package_id, concat('pkg-', p.page_id) AS name,
  CASE p.page_id % 3 WHEN 0 THEN concat('Drucksache ', p.page_id) ELSE concat('Page ', p.page_id) END AS title,
  CASE WHEN p.page_id % 17 = 16 THEN 'deleted' ELSE 'active' END AS state,
  CASE WHEN p.page_id % 19 = 18 THEN 'harvest' ELSE 'dataset' END AS type,
  p.url AS url, e.ts AS metadata_modified, e.user_id AS owner
FROM {pages} p JOIN {events} e ON e.event_id = p.page_id
""",
    "resource": """
SELECT concat('r', doc_id) AS resource_id, concat('p', CAST(floor(doc_id / 4) AS BIGINT)) AS package_id,
  doc_id % 4 AS position, lang AS format, source,
  CASE WHEN doc_id % 10 = 3 THEN concat(CASE WHEN doc_id % 20 = 13 THEN 'http' ELSE 'https' END,
         '://sitzungsdienst.example.org/ti/vo020.asp?x=', doc_id)
       WHEN doc_id % 23 = 5 THEN concat('https://files.example.org/alkis_liegenschaftskarte/', doc_id)
       ELSE concat(CASE WHEN doc_id % 6 = 2 THEN 'http' ELSE 'https' END, '://files.example.org/', source, '/', doc_id,
         CASE doc_id % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.ZIP' WHEN 2 THEN '.gml' WHEN 4 THEN '.html' ELSE '' END)
  END AS url,
  CASE WHEN doc_id % 4 = 1 THEN concat('Sitzungsprotokoll (Druckversion) ', doc_id) ELSE concat('res ', doc_id) END AS name,
  n_chars AS file_size
FROM {documents}
""",
    "fulltext": """
SELECT concat('f', doc_id) AS id, concat('r', doc_id) AS resource_id,
  concat('p', CAST(floor(doc_id / 4) AS BIGINT)) AS package_id,
  CASE doc_id % 29 WHEN 0 THEN 'UNPROCESSED_FULLTEXT' WHEN 1 THEN 'ERROR_FULLTEXT'
    WHEN 2 THEN '   Wrong parameter set   ' WHEN 3 THEN 'NOT_AVAILABLE' WHEN 4 THEN '' ELSE text END AS text,
  CASE WHEN doc_id % 3 = 0 THEN NULL ELSE replace(text, '.', '') END AS text_clear
FROM {documents} WHERE doc_id % 7 <> 6
UNION ALL
SELECT concat('g', doc_id), concat('r', doc_id), concat('p', CAST(floor(doc_id / 4) AS BIGINT)),
  'UNPROCESSED_FULLTEXT', NULL
FROM {documents} WHERE doc_id % 11 = 5
""",
    "incoming": """
SELECT concat('p', CAST(floor(doc_id / 4) AS BIGINT)) AS package_id, concat('r', doc_id) AS resource_id,
  doc_id % 4 AS position, CASE WHEN doc_id % 8 = 1 THEN '  ' ELSE concat(text, ' v2') END AS text
FROM {documents} WHERE doc_id % 5 <> 0
""",
    "harvest": """
SELECT concat('p', page_id) AS package_id, page_id % 5 <> 0 AS current,
  CASE WHEN page_id % 7 = 0 THEN 'ERROR' ELSE 'COMPLETE' END AS state,
  concat('https://h.example.org/ti/vo020.asp#volfdnr=', page_id, '#guid=', page_id * 10) AS guid,
  concat('source', page_id % 3) AS source_title
FROM {pages}
UNION ALL
SELECT concat('p', page_id), true, 'COMPLETE', 'second', 'source9' FROM {pages} WHERE page_id % 9 = 4
""",
    "members": """
SELECT conv_id AS archive_id,
  CASE WHEN conv_id % 3 = 0 THEN NULL ELSE CAST(floor(conv_id / 3) AS BIGINT) END AS parent_id,
  turn AS seq, concat('a', conv_id, '/', turn, CASE role WHEN 'system' THEN '.gml' ELSE '.txt' END) AS path, text
FROM {conversations}
""",
    "attempts": """
SELECT concat('p', user_id) AS package_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS attempt_no,
  ts AS ended_at, event_type = 'error' AS failed, event_type AS error_class
FROM {events}
""",
}

# Driver tables each view reads.
VIEW_INPUTS = {
    name: sorted(set(re.findall(r"\{(\w+)\}", sql))) for name, sql in VIEW_SQL.items()
}

# The word list: letters-only words of two or more letters from `benchmark`.
DICTIONARY_ORACLE = r"""
SELECT DISTINCT word FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS word FROM benchmark) w
WHERE length(word) >= 2
"""


def render_for_oracle(name: str) -> str:
    """The view's SQL with plain table names (for DuckDB)."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEW_SQL[name])


def with_views(query: str, extra: dict[str, str] | None = None) -> str:
    """Prefix an oracle query with the CTEs of the views it mentions."""
    ctes = dict((k, render_for_oracle(k)) for k in VIEW_SQL)
    ctes["dictionary"] = DICTIONARY_ORACLE
    ctes.update(extra or {})
    used: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name, body in ctes.items():
            if name not in seen and re.search(rf"\b{name}\b", text) and name not in _BASE:
                seen.add(name)
                visit(body)
                used.append(name)

    visit(query)
    if not used:
        return query
    parts = ",\n".join(f"{n} AS ({ctes[n].strip()})" for n in used)
    q = query.strip()
    m = re.match(r"(?i)^with(\s+recursive)?\b", q)
    if m:
        head = "WITH RECURSIVE" if m.group(1) else "WITH"
        return f"{head} {parts},\n{q[m.end():].lstrip()}"
    return f"WITH {parts}\n{q}"


_BASE = {"documents", "pages", "events", "benchmark", "conversations", "labels"}
