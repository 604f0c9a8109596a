"""Queries over everything their tables hold; the SQL here has no cut."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from foliomill.operators import lineage
from foliomill.plans import registry

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def asked(sql, data=DATA):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(data):
        path = f"{data}/{name}" + ("/*.parquet" if os.path.isdir(f"{data}/{name}") else "")
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path}'")
    return sorted(con.execute(sql).fetchall(), key=repr)


def given(spark, name, *columns, data=DATA):
    return sorted((tuple(r) for r in registry.QUERIES[name](spark, data).select(*columns).collect()), key=repr)


PAGES = """SELECT source_artifact_id, md5(string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY page_index, text_id)), count(*) FILTER (text IS NULL OR trim(text) = '')
           FROM source_texts WHERE page_index IS NOT NULL GROUP BY 1"""


@needs_tables
def test_page_reconstruct_has_every_artifact(spark):
    got = given(spark, "q_page_reconstruct", "source_artifact_id", "h", "n_open")
    assert got == asked(PAGES)
    assert "art-000000000" in [r[0] for r in got]


def test_page_reconstruct_null_key(spark, tmp_path):
    rows = [(1, None, 2, "b"), (2, None, 1, "a"), (3, "x", 1, None), (4, "x", 2, " "), (5, "x", None, "no page")]
    spark.createDataFrame(rows, "text_id long, source_artifact_id string, page_index int, text string").write.parquet(f"{tmp_path}/source_texts.parquet")
    got = given(spark, "q_page_reconstruct", "source_artifact_id", "h", "n_open", data=str(tmp_path))
    assert got == asked(PAGES, str(tmp_path)) and len(got) == 2


RANGES = """WITH r AS (SELECT source_artifact_id, min(page_index) AS first, max(page_index) AS last FROM source_texts WHERE page_index IS NOT NULL GROUP BY 1),
                 a AS (SELECT *, unnest(range(first, last + 1)) AS p FROM r), h AS (SELECT DISTINCT source_artifact_id, page_index FROM source_texts)
            SELECT a.source_artifact_id, first, last, count(h.page_index) AS n_found, coalesce(list_sort(list(p::INT) FILTER (h.page_index IS NULL)), []) AS missing
            FROM a LEFT JOIN h ON a.source_artifact_id = h.source_artifact_id AND p = h.page_index GROUP BY ALL"""


@needs_tables
def test_page_range_lookup_has_whole_ranges(spark):
    got = given(spark, "q_page_range_lookup", "source_artifact_id", "first", "last", "n_found", "missing")
    assert got == asked(RANGES)
    assert max(r[2] - r[1] for r in got) > 9


def test_page_range_lookup_long_range(spark, tmp_path):
    rows = [("x", 5), ("x", 7), ("x", 10_000), ("y", -3), ("y", 1), (None, 2), (None, 4), ("z", None)]
    spark.createDataFrame(rows, "source_artifact_id string, page_index int").write.parquet(f"{tmp_path}/source_texts.parquet")
    got = given(spark, "q_page_range_lookup", "source_artifact_id", "first", "last", "n_found", "missing", data=str(tmp_path))
    assert got == asked(RANGES, str(tmp_path)) and len(got) == 3


def test_coverage_is_the_registry():
    """Every line of the list says yes, partial or no; what it says is there names queries or functions that exist."""
    text = open(os.path.join(os.path.dirname(__file__), "..", "COVERAGE.md")).read()
    lines = re.findall(r"^\| ([A-Z]{3}-\d\d) \| (yes|partial|no) \| (.*) \| (.*) \|$", text, re.M)
    state = {k: s for k, s, _, _ in lines}
    assert len(lines) == len(state) == 335
    count = lambda s: sum(x == s for x in state.values())
    assert f"{count('yes')} yes, {count('partial')} partial, {count('no')} no" in text
    for k, s, where, lacks in lines:
        assert (s == "no") == (where == "–") and (s == "partial") <= bool(lacks.strip("– ")), k
        assert all(name in registry.QUERIES for name in re.findall(r"`(q_\w+)`", where)), k
    shown = {k for covers in registry.COVERS.values() for k in covers.split()}
    assert not shown - {k for k, s in state.items() if s != "no"}


def test_closure_of_a_long_chain(spark):
    edges = spark.range(66).selectExpr("id AS src", "id + 1 AS dst").coalesce(1)
    pairs = lineage.closure(edges).selectExpr("count(*)", "max(depth)", "count_if(depth != dst - src)").first()
    assert tuple(pairs) == (66 * 67 // 2, 66, 0)


RELATIONS = """WITH e AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM customer JOIN orders ON o_custkey = c_custkey
                 JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey)
               SELECT n_nationkey, src, dst FROM nation JOIN e ON src = n_nationkey OR dst = n_nationkey"""


@needs_tables
def test_endpoint_relations_of_all_orders(spark):
    assert given(spark, "q_endpoint_relations", "n_nationkey", "src", "dst") == asked(RELATIONS)


SPANS = """SELECT candidate_id, CASE WHEN text IS NULL THEN 'no_page' WHEN coalesce(candidate_text, '') = '' THEN 'no_text'
             WHEN starts_with(text, candidate_text) THEN 'exact'
             WHEN len(list_filter(range(1, length(candidate_text) + 1, 40), lambda i: NOT contains(text, substr(candidate_text, i, 40)))) = 0 THEN 'moved' ELSE 'not_found' END
           FROM candidate_texts LEFT JOIN source_texts USING (text_id)"""


@needs_tables
def test_evidence_spans_of_all_candidates(spark):
    assert given(spark, "q_evidence_spans", "candidate_id", "evidence") == asked(SPANS)


def test_evidence_spans_look_at_the_whole_text(spark, tmp_path):
    page = "".join(chr(0x4E00 + i) for i in range(300))
    cand = [page[:120], page[:60] + "?" + page[61:120], page[80:120] + page[:70], page[:9], "?", "", None, page]
    spark.createDataFrame([(1, page), (2, None)], "text_id long, text string").write.parquet(f"{tmp_path}/source_texts.parquet")
    rows = [(i, 2 if i == 7 else 1, c) for i, c in enumerate(cand)]
    spark.createDataFrame(rows, "candidate_id long, text_id long, candidate_text string").write.parquet(f"{tmp_path}/candidate_texts.parquet")
    got = given(spark, "q_evidence_spans", "candidate_id", "evidence", data=str(tmp_path))
    assert [r[1] for r in got] == ["exact", "not_found", "moved", "exact", "not_found", "no_text", "no_text", "no_page"]
    assert got == asked(SPANS, str(tmp_path))
