"""Driver contract and the DuckDB oracle on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "pages", "benchmark", "labels", "conversations"]
QUICK = ["package_texts", "merge_result", "attach_fulltext_limited", "normalise_url", "fulltext_url",
         "clear_text", "wrong_words", "search_ranked", "facets", "archive_text", "redirect_text",
         "failure_report", "outcome", "hide_extras_list", "package_list_page", "stream_ingest", "stream_outcomes",
         "postings", "index_maintained", "search_after_update", "apply_outcome", "process_packages", "process_packages_index",
         "package_update", "package_create", "package_show_reduced", "package_show_map", "package_list_views", "package_list_deep",
         "package_list_after", "work_selection_one", "preprocess_tokens"]


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"package_id", "resource_id", "text", "text_clear", "in_error"} <= set(df.columns)


def test_registry_consistent():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 100


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", QUICK)
def test_against_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert norm([tuple(r) for r in df.collect()], df.columns) == norm(rel.fetchall(), rel.columns)
