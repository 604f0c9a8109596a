import json
from datetime import datetime

import pytest
from tests.conftest import rows

from foliomill.operators.commits import ConcurrentRun
from foliomill.operators.compaction import Journal, Tiers, compact, named_records

LINES = "object_key string, line_no int, line_text string"
OBJECTS = "key string, size bigint, last_modified double, listed_at timestamp"
T = datetime(2024, 1, 1)
TINY = Tiers(base_bytes=64, fanout=4, target_bytes=600)


def record(i, at="2023-11-01T00:00:00Z", **more):
    return json.dumps({"source_identifier": f"k{i}", "recorded_at": at, "byte_count": i, **more})


STEPS = Tiers(base_bytes=300, fanout=4, target_bytes=4000)


def run(spark, lines, objects=(), workdir=None, tiers=TINY):
    return compact(spark.createDataFrame(lines, LINES), spark.createDataFrame(list(objects), OBJECTS), tiers, workdir)


def test_equal_records_have_one_name(spark):
    texts = [
        '{"a": 1, "recorded_at": "2023-11-01T00:00:00Z"}',
        '{ "recorded_at":"2023-11-01T01:00:00.000+01:00" , "a":1, "b":null}',
        '{"a": 2, "recorded_at": "2023-11-01T00:00:00Z"}',
        '{"a": 1, "recor',
        "",
        None,
        "[1]",
        "7",
        '{"a": 1} x',
        '{"a": 1} {"a": 1}',
        '{"a": 1}, {"a": 1}',
        '{"a": 1}, 7',
    ]
    got = [r[0] for r in named_records(spark.createDataFrame([(t,) for t in texts], "line_text string")).select("record").collect()]
    assert got[0] == got[1] and got[0] != got[2] and got[0] is not None and got[3:] == [None] * 9


def test_each_record_once_and_first_kept(spark):
    lines = [(f"f{i % 7}", i, record(i % 20)) for i in range(100)] + [("f0", 200, ""), ("f0", 201, '{"a'), ("f0", 202, None)]
    objects = [(f"f{i}", 10 * i, 1.0, T) for i in range(5)] + [("f1", 5000, 2.0, T)]
    out = run(spark, lines, objects)
    kept = rows(out.records.select("object_key", "line_no"))
    want = {}
    for k, n, t in lines:
        if t and t.endswith("}"):
            want[t] = min(want.get(t, (k, n)), (k, n))
    assert kept == sorted(want.values(), key=repr)
    dropped = rows(out.dropped.select("object_key", "line_no"))
    assert len(dropped) == 80 and not set(dropped) & set(kept)
    assert out.records.select("file").distinct().count() > 1


def test_second_run_changes_nothing(spark, tmp_path):
    lines = [(f"f{i % 3}", i, record(i % 5)) for i in range(20)]
    first = run(spark, lines, workdir=f"file://{tmp_path}/w")
    a, b, n = rows(first.records), rows(first.dropped), first.journal.count()
    second = run(spark, lines, workdir=f"file://{tmp_path}/w")
    assert (rows(second.records), rows(second.dropped), second.journal.count()) == (a, b, n)


def test_new_files_join_what_is_there(spark, tmp_path):
    lines = [("a", 1, record(1)), ("b", 1, record(2))]
    run(spark, lines, workdir=f"file://{tmp_path}/w")
    more = run(spark, [*lines, ("A", 1, record(2)), ("c", 1, record(3))], workdir=f"file://{tmp_path}/w")
    assert rows(more.records.select("object_key", "line_no")) == [("A", 1), ("a", 1), ("c", 1)]
    assert rows(more.dropped.select("object_key", "line_no")) == [("b", 1)]


def test_one_more_object_rewrites_only_what_it_meets(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    lines = [(f"f{i % 60:02d}", i, record(i)) for i in range(180)]
    first = run(spark, lines, workdir=path, tiers=STEPS)
    before = {r["txn"]: r for r in first.journal.collect()}
    assert len(before) == first.journal.count() and {1, 2} <= {r["level"] for r in before.values()}
    files = {r[0] for r in first.records.select("file").collect()}
    more = run(spark, [*lines, ("zz", 1, record(1000)), ("zz", 2, record(5))], workdir=path, tiers=STEPS)
    after = {r["txn"]: r for r in more.journal.collect()}
    # an object alone in its tier waits; no transaction is written again and no file changes its name
    assert after == before and {r[0] for r in more.records.select("file").collect()} - files == {r[0] for r in more.records.where("line_no = 1 and object_key = 'zz'").select("file").collect()}
    assert rows(more.dropped.select("object_key", "line_no")) == [("zz", 2)] and more.records.count() == 181
    third = run(spark, [*lines, ("zz", 1, record(1000)), ("zz", 2, record(5)), ("zzz", 1, record(1001))], workdir=path, tiers=STEPS)
    new = [r for r in third.journal.collect() if r["txn"] not in before]
    assert len(new) == 1 and new[0]["inputs"] == 2 and new[0]["records_in"] == 3 and new[0]["records_out"] == 2
    assert third.records.count() == 182 and third.records.select("record").distinct().count() == 182


def test_a_merge_is_one_file_and_old_levels_go(spark, tmp_path):
    lines = [(f"f{i % 60:02d}", i, record(i)) for i in range(180)]
    out = run(spark, lines, workdir=f"file://{tmp_path}/w", tiers=STEPS)
    journal = out.journal.collect()
    inputs = {f for r in journal for f in r["files"]}
    live = [r for r in journal if r["txn"] not in inputs]
    held = [p for p in (tmp_path / "w" / "data").rglob("*.parquet")]
    assert sorted(p.parent.name for p in held) == sorted(f"file={r['txn']}" for r in live)
    assert sum(r["records_out"] for r in live) == 180


def test_two_runs_at_once(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    run(spark, [("a", 1, record(1)), ("b", 1, record(2))], workdir=path)
    one, two = Journal(spark, path), Journal(spark, path)
    one.commit(index=None)
    with pytest.raises(ConcurrentRun):
        two.commit(index=None)


def test_waits_unless_closed(spark, tmp_path):
    lines = [("a", 1, record(1)), ("b", 1, record(2)), ("b", 2, record(1))]
    df = spark.createDataFrame(lines, LINES)
    listing = spark.createDataFrame([("a", 10, 1.0, T), ("b", 10, 1.0, T)], OBJECTS)
    out = compact(df, listing, TINY, f"file://{tmp_path}/w", close=False)
    assert out.journal.count() == 0 and out.records.count() == 2 and out.dropped.count() == 1


def test_a_record_sent_everywhere_and_repeated_rows(spark):
    lines = [(f"f{i:03d}", j, record(0)) for i in range(80) for j in (1, 2)] + [("f000", 1, record(0))]
    out = run(spark, lines)
    assert rows(out.records.select("object_key", "line_no")) == [("f000", 1)] and out.dropped.count() == 159


def test_empty_and_null_places(spark):
    assert rows(run(spark, []).records) == []
    out = run(spark, [(None, None, record(1)), ("a", 1, record(1))])
    assert rows(out.records.select("object_key", "line_no")) == [(None, None)]
    assert rows(out.dropped.select("object_key", "line_no")) == [("a", 1)]
