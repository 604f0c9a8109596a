import os

import pytest

from foliomill.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
COLUMNS = {
    "p1_found": [("table_name", "string"), ("record_id", "bigint")],
    "p4_found": [("table_name", "string"), ("record_id", "bigint")],
    "p5_found": [("text_id", "bigint")],
    "p6_ids": [("doc_id", "bigint"), ("ids", "array<bigint>")],
    "p8_found": [("doc_id_a", "bigint"), ("doc_id_b", "bigint")],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
    got = df.collect()
    assert got
    if name.endswith("_found"):
        assert len(set(got)) == len(got)
